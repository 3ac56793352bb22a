"""Sources: registry, standard records, offline readers and an opt-in online reader."""

from tamis.sources.records import RECORD, atom_records, code_host_records, describe
from tamis.sources.registry import Source, discover, get_source, register_source

__all__ = ["RECORD", "Source", "atom_records", "code_host_records", "describe", "discover", "get_source", "register_source"]
