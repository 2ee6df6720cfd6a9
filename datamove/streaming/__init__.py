from datamove.streaming.files_once import Landing, ingest_files_once, replace_with_new_files

__all__ = ["Landing", "ingest_files_once", "replace_with_new_files"]
