"""Web-archive tables on Spark: archives in, keyed document tables out."""

import sys

from pyspark import cloudpickle

from warcloom.functions.identity import doc_uuid, java_hash, partition_id
from warcloom.operators.counters import (
    counters,
    merge_counters,
    observe_counters,
    split_counter,
)
from warcloom.operators.docs import build_docs, choose_encoding
from warcloom.operators.lookup import documents_by_uri, lookup, missing_keys, render
from warcloom.operators.records import (
    keep_http_records,
    parse_headers,
    parse_records,
    split_http,
    to_warc_text,
    uri_rows,
    with_record_id,
)
from warcloom.operators.segments import segment_range
from warcloom.operators.tables import (
    check_mergeable,
    first_per_key,
    map_rows,
    merge_tables,
    partition_table,
)
from warcloom.plans.jobs import SegmentError, add_to_tables, build_corpus, build_tables, list_segments, merge_batches
from warcloom.profiles import PROFILES, Profile, get_profile
from warcloom.sinks.map_files import write_map_files
from warcloom.sinks.tables import drop_superseded, segment_path, write_merged, write_tables
from warcloom.sinks.warc import write_warc
from warcloom.sources.map_files import read_map_files
from warcloom.sources.tables import (
    Tables,
    distinct_splits,
    keep_table_splits,
    list_splits,
    open_tables,
)
from warcloom.sources.warc import read_warc, warc_files

# Tasks carry the code they run, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [name for name in dir() if not name.startswith("_")]
