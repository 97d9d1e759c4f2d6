from maskwright.sources.members import member_columns, members
from maskwright.sources.records import (
    conform,
    count_by_unit,
    read_delimited,
    read_records,
    with_record_count,
    write_records,
)
from maskwright.sources.routing import Routed, read_lines, split_by_unit, split_files
from maskwright.sources.schemas import MEMBER, MEMBER_INPUT, schema_from_avro

__all__ = [
    "MEMBER",
    "MEMBER_INPUT",
    "Routed",
    "conform",
    "count_by_unit",
    "member_columns",
    "members",
    "read_delimited",
    "read_lines",
    "read_records",
    "schema_from_avro",
    "split_by_unit",
    "split_files",
    "with_record_count",
    "write_records",
]
