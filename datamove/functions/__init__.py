from datamove.functions.flatten import flatten_structs
from datamove.functions.normalize import normalize_types

__all__ = ["flatten_structs", "normalize_types"]
