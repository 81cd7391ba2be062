"""DataFrame -> DataFrame operators."""

from statflow.operators.changes import apply_changes, changed_keys, snapshot_changes
from statflow.operators.htmlblocks import extract_page_row_parsed, parsed_blocks
from statflow.operators.htmlpaths import extract_page_row_paths, path_blocks
from statflow.operators.ordered import running_totals
from statflow.operators.profile import (
    Profile,
    Rule,
    apply_profile,
    check_columns,
    check_contract,
    floats,
    ints,
    profile_contract,
    stringify,
)
from statflow.operators.relate import (
    distinct_keys,
    heavy_keys,
    inner_join,
    isin_filter,
    lookup_or_self,
    lookup_udf,
    map_lookup,
    row_count,
    semi_reduce,
    skew_join,
)
from statflow.operators.unpack import (
    drop_short_rows,
    extract_page_row,
    flag_malformed,
    html_lines,
    html_text,
    name_positional,
    page_row_is_bad,
    payload_headers,
    split_flagged,
    split_malformed,
    unpack_rowset,
    unpack_rowset_checked,
    unpack_rowset_flagged,
)
from statflow.operators.wordcount import word_count

__all__ = [
    "Profile",
    "Rule",
    "apply_changes",
    "apply_profile",
    "changed_keys",
    "check_columns",
    "check_contract",
    "distinct_keys",
    "drop_short_rows",
    "extract_page_row",
    "extract_page_row_parsed",
    "extract_page_row_paths",
    "flag_malformed",
    "floats",
    "heavy_keys",
    "html_lines",
    "html_text",
    "inner_join",
    "ints",
    "isin_filter",
    "lookup_or_self",
    "lookup_udf",
    "map_lookup",
    "name_positional",
    "page_row_is_bad",
    "parsed_blocks",
    "path_blocks",
    "payload_headers",
    "profile_contract",
    "row_count",
    "semi_reduce",
    "skew_join",
    "split_malformed",
    "stringify",
    "unpack_rowset",
    "unpack_rowset_checked",
    "word_count",
]
