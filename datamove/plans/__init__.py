from datamove.plans.jobs import Flips, Job, Outcome, jobs_for_group, record_flip, run_group, run_job, to_jobs
from datamove.plans.raw import LoadResult, RawLoad, load_raw

__all__ = [
    "Flips",
    "Job",
    "LoadResult",
    "Outcome",
    "RawLoad",
    "jobs_for_group",
    "load_raw",
    "record_flip",
    "run_group",
    "run_job",
    "to_jobs",
]
