"""Sources and sinks: driver tables, topic, table store, archive, samples."""

from tidemark.sources.samples import read_samples, samples_from_events
from tidemark.sources.store import read_archive, read_table, purge_table, write_archive, write_table
from tidemark.sources.tables import readings_from_events
from tidemark.sources.topic import raw_records, read_raw_files, read_topic, write_topic

__all__ = [
    "raw_records", "read_archive", "read_raw_files", "read_samples", "read_table",
    "read_topic", "readings_from_events", "samples_from_events", "purge_table", "write_archive",
    "write_table", "write_topic",
]
