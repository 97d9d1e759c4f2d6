"""The same results in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

from acceptance.digests_sql import (
    fingerprint64_to_32_bytes,
    fingerprint64_to_64_bytes,
    fingerprint64_to_128_bytes,
    sha384,
    sha512,
)
from acceptance.settings import ATTRIBUTES, KEY, SEED
from maskwright.sources.members import FIRST_NAMES, LAST_NAMES

BLANK = (
    r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}"
    r"\x{2028}\x{2029}\x{205F}\x{3000}]*"
)


def message(value: str) -> str:
    return f"'{KEY}' || {value} || base64(encode({value}))"


def guarded(value: str, digest: str) -> str:
    return f"CASE WHEN regexp_full_match({value}, '{BLANK}') THEN {value} ELSE {digest} END"


def sha256(value: str) -> str:
    return guarded(value, f"sha256({message(value)})")


def number(hexadecimal: str) -> str:
    return f"('0x' || {hexadecimal})::BIGINT"


def octets(text: str) -> str:
    """The bytes of a text as a list of integers."""
    pairs = f"regexp_extract_all(hex(encode({text})), '..')"
    return f"list_transform({pairs}, lambda i: {number('i')})"


def least_byte_first(value: str) -> str:
    digits = f"printf('%08x', ({value})::BIGINT)"
    return " || ".join(f"substr({digits}, {place}, 2)" for place in (7, 5, 3, 1))


def crc_table(polynomial: int) -> str:
    entries = []
    for entry in range(256):
        for _ in range(8):
            entry = (entry >> 1) ^ (polynomial if entry & 1 else 0)
        entries.append(f"{entry}::BIGINT")
    return "[" + ", ".join(entries) + "]"


def crc(value: str, polynomial: int) -> str:
    start = f"list_prepend(4294967295::BIGINT, {octets(message(value))})"
    step = f"xor(a >> 8, ({crc_table(polynomial)})[(xor(a, x) & 255) + 1])"
    register = f"list_reduce({start}, lambda a, x: {step})"
    return guarded(value, least_byte_first(f"xor({register}, 4294967295::BIGINT)"))


def adler32(value: str) -> str:
    low = "((s & 65535) + x) % 65521"
    step = f"(((s >> 16) + {low}) % 65521) * 65536 + {low}"
    start = f"list_prepend(1::BIGINT, {octets(message(value))})"
    digest = least_byte_first(f"list_reduce({start}, lambda s, x: {step})")
    # The list of a null text is not null.
    return f"CASE WHEN {value} IS NOT NULL THEN {guarded(value, digest)} END"


# Every kind of value: null, empty, blank, a no-break space (not blank), a name.
EDGE = (
    "CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' "
    "WHEN 3 THEN chr(160) ELSE c_name END"
)
WORDS = "string_split(p_name, ' ')"


def joined(array: str, digest: str) -> str:
    return f"array_to_string(list_transform({array}, lambda w: {digest}), '|')"


def digits(purpose: str, id: str, length: int) -> str:
    digest = f"md5('{SEED}:{purpose}:' || {id}::VARCHAR)"
    drawn = number(f"substr({digest}, 1, 15)")
    return f"lpad(({drawn} % {10**length})::VARCHAR, {length}, '0')"


def drawn_name(purpose: str, id: str, names: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{name}'" for name in names)
    return f"([{listed}])[{digits(purpose, id, 9)}::BIGINT % {len(names)} + 1]"


PHONE = digits("phone", "c_custkey", 10)
ORDER_LINE = (
    """'{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}'"""
)



def hashed(table: str, id: str, value: str, digest) -> str:
    """A column of a table hashed by one of the digests written as queries."""
    source = digest(f"SELECT {id}, {value} AS v, encode({message(value)}) AS m FROM {table}")
    return f"SELECT {id}, {guarded('v', 'digest')} AS {value} FROM ({source})"


HASHED_ORDERS = (
    f"SELECT o_orderkey, {sha256('o_orderpriority')} AS o_orderpriority, o_orderstatus, "
    "(SELECT count(*)::INTEGER FROM orders) AS record_count FROM orders"
)
SPLIT_SUPPLIERS = (
    f"SELECT 'success' AS route, s_nationkey::INTEGER AS s_nationkey, s_suppkey, "
    f"{sha256('s_name')} AS s_name FROM supplier WHERE s_nationkey NOT IN (3, 7) "
    "UNION ALL SELECT DISTINCT 'failure', s_nationkey::INTEGER, NULL, NULL FROM supplier "
    "WHERE s_nationkey IN (3, 7)"
)
LINEITEM_KEYS = ("l_orderkey", "l_partkey", "l_suppkey")


def lineitem(digest) -> str:
    texts = ", ".join(f"{name}::VARCHAR AS {name}" for name in LINEITEM_KEYS)
    columns = ", ".join(f"{digest(name)} AS {name}" for name in LINEITEM_KEYS)
    return f"SELECT l_linenumber, {columns} FROM (SELECT l_linenumber, {texts} FROM lineitem)"


def named(name: str, digest) -> str:
    of_parts = hashed("part", "p_partkey", "p_name", digest)
    return f"JOIN (SELECT p_partkey, p_name AS {name} FROM ({of_parts})) USING (p_partkey)"


LINEITEM = {
    "lineitem_sha256": lineitem(sha256),
    "lineitem_crc32": lineitem(lambda v: crc(v, 0xEDB88320)),
    "lineitem_crc32c": lineitem(lambda v: crc(v, 0x82F63B78)),
    "lineitem_adler32": lineitem(adler32),
}

ORACLES = {
    "keyed_sha256": f"SELECT c_custkey, {sha256('c_name')} AS c_name FROM customer",
    "long_text": f"SELECT doc_id, {sha256('text')} AS text FROM documents",
    "blank_guard": f"SELECT c_custkey, {sha256('v')} AS v "
    f"FROM (SELECT c_custkey, {EDGE} AS v FROM customer)",
    "crc32": f"SELECT p_partkey, {crc('p_name', 0xEDB88320)} AS p_name FROM part",
    "crc32c": f"SELECT p_partkey, {crc('p_name', 0x82F63B78)} AS p_name FROM part",
    "adler32": f"SELECT p_partkey, {adler32('p_name')} AS p_name FROM part",
    "crc32_reference_dispatch": f"SELECT p_partkey, {adler32('p_name')} AS p_name FROM part",
    "sha384": hashed("part", "p_partkey", "p_name", sha384),
    "sha512": hashed("part", "p_partkey", "p_name", sha512),
    "farm_fingerprint64": hashed("part", "p_partkey", "p_name", fingerprint64_to_64_bytes),
    "farm_fingerprint64_names": hashed(
        "customer", "c_custkey", "c_name", fingerprint64_to_128_bytes
    ),
    "adler32_blank_guard": f"SELECT c_custkey, {adler32('v')} AS v "
    f"FROM (SELECT c_custkey, {EDGE} AS v FROM customer)",
    "multi_in_place": f"SELECT c_custkey, {sha256('c_name')} AS c_name, c_nationkey, c_acctbal, "
    f"{sha256('c_mktsegment')} AS c_mktsegment FROM customer",
    "hash_to_new_column": "SELECT s_suppkey, s_name, NULL::VARCHAR AS note, "
    f"{sha256('s_name')} AS hashed_s_name FROM supplier",
    "sequential_chain": f"SELECT c_custkey, {sha256('h')} AS c_name, h AS c_mktsegment "
    f"FROM (SELECT c_custkey, {sha256('c_name')} AS h FROM customer)",
    "missing_source_nulls": "SELECT c_custkey, NULL::VARCHAR AS c_name, c_nationkey, c_acctbal, "
    "c_mktsegment FROM customer",
    "missing_pair_noop": "SELECT * FROM customer",
    "int_source": f"SELECT c_custkey, {sha256('n')} AS c_nationkey "
    "FROM (SELECT c_custkey, c_nationkey::VARCHAR AS n FROM customer)",
    "nested_paths": f"SELECT c_custkey, {sha256('c_name')} AS name, c_mktsegment AS segment, "
    f"{sha256('n')} AS nation "
    "FROM (SELECT *, c_nationkey::VARCHAR AS n FROM customer)",
    "array_paths": f"SELECT doc_id, {joined(WORDS.replace('p_name', 'text'), sha256('w'))} "
    "AS words FROM documents",
    "array_paths_arrow": f"SELECT p_partkey, {joined(WORDS, adler32('w'))} AS words FROM part",
    "map_paths": f"SELECT o_orderkey, {sha256('o_orderstatus')} AS status, "
    f"{sha256('o_orderpriority')} AS priority FROM orders",
    "relative_path": f"SELECT c_custkey, {sha256('c_mktsegment')} AS name, "
    f"{sha256('c_mktsegment')} AS segment FROM customer",
    "descendant_paths": f"SELECT c_custkey, {sha256('k')} AS outer_name, {sha256('k')} AS "
    "inner_name FROM (SELECT c_custkey, c_custkey::VARCHAR AS k FROM customer)",
    "nest_fields": "SELECT c_custkey, c_name AS name, c_mktsegment AS segment FROM customer",
    "project_fields": "SELECT c_name, c_mktsegment FROM customer",
    "attribute_mapping": f"SELECT c_custkey, {sha256(ATTRIBUTES['column'])} AS token "
    "FROM customer",
    "dictionary": f"SELECT {sha256('v')} AS hash, v AS plaintext FROM "
    "(SELECT c_name AS v FROM customer UNION ALL SELECT c_mktsegment FROM customer)",
    "dictionary_edges": f"SELECT {sha256('v')} AS hash, v AS plaintext FROM (SELECT {EDGE} AS v "
    "FROM customer UNION ALL SELECT c_mktsegment FROM customer) WHERE v IS NOT NULL AND v <> ''",
    "dictionary_names": f"SELECT {sha256('c_name')} AS token, c_name AS clear FROM customer",
    "dictionary_of_words": f"SELECT {sha256('v')} AS hash, v AS plaintext FROM "
    "(SELECT unnest(string_split(text, ' ')) AS v FROM documents) WHERE v <> ''",
    "lookup_struct": f"SELECT o_orderkey, {sha256('o_orderstatus')} AS status, "
    f"{sha256('o_orderpriority')} AS priority FROM orders",
    "lookup_map": f"SELECT o_orderkey, {sha256('o_orderstatus')} AS status, "
    f"{sha256('o_orderpriority')} AS priority FROM orders",
    "record_count": "SELECT count(*) AS record_count FROM events",
    "conform": "SELECT c_custkey::VARCHAR AS c_custkey, c_name, NULL::VARCHAR AS note, "
    "NULL::DOUBLE AS score FROM customer",
    "csv_round_trip": f"SELECT c_custkey, {sha256('c_name')} AS c_name, c_mktsegment "
    "FROM customer",
    "json_round_trip": f"SELECT o_orderkey, {sha256('o_orderpriority')} AS o_orderpriority "
    "FROM orders",
    "orc_round_trip": f"SELECT s_suppkey, {sha256('s_name')} AS s_name FROM supplier",
    "xml_round_trip": f"SELECT s_suppkey, {sha256('s_name')} AS s_name FROM supplier",
    "text_lines": f"SELECT {sha256('p_name')} AS value FROM part",
    "failure_split": "SELECT 'success' AS route, o_orderkey, "
    f"{sha256('o_orderstatus')} AS content FROM orders WHERE o_orderpriority <> '1-URGENT' "
    "UNION ALL SELECT 'failure', o_orderkey, CASE WHEN o_orderstatus = 'F' THEN "
    f"left({ORDER_LINE}, length({ORDER_LINE}) - 1) ELSE {ORDER_LINE} END "
    "FROM orders WHERE o_orderpriority = '1-URGENT'",
    "stream_hash": f"SELECT event_id, {sha256('event_type')} AS event_type FROM events",
    "stream_routing": "SELECT 'success' AS route, o_orderkey, "
    f"{sha256('o_orderstatus')} AS content FROM orders WHERE o_orderpriority <> '1-URGENT' "
    "UNION ALL SELECT 'failure', o_orderkey, "
    f"left({ORDER_LINE}, length({ORDER_LINE}) - 1) FROM orders "
    "WHERE o_orderpriority = '1-URGENT'",
    "members": f"SELECT {digits('member', 'c_custkey', 16)} AS member_id, "
    f"{drawn_name('first', 'c_custkey', FIRST_NAMES)} AS first_name, "
    f"{drawn_name('last', 'c_custkey', LAST_NAMES)} AS last_name, "
    f"substr({PHONE}, 1, 3) || '-' || substr({PHONE}, 4, 3) || '-' || substr({PHONE}, 7, 4) "
    f"AS phone_number, {drawn_name('parent', 'c_custkey', LAST_NAMES)} AS parent_name "
    "FROM customer",
    "hashed_members": f"SELECT *, {sha256('first_name')} AS hashed_first_name, "
    f"{sha256('last_name')} AS hashed_last_name FROM (SELECT "
    f"{digits('member', 'c_custkey', 16)} AS member_id, "
    f"{drawn_name('first', 'c_custkey', FIRST_NAMES)} AS first_name, "
    f"{drawn_name('last', 'c_custkey', LAST_NAMES)} AS last_name, "
    f"substr({PHONE}, 1, 3) || '-' || substr({PHONE}, 4, 3) || '-' || substr({PHONE}, 7, 4) "
    f"AS phone_number, {drawn_name('parent', 'c_custkey', LAST_NAMES)} AS parent_name "
    "FROM customer)",
    "sql_functions": f"SELECT p_partkey, {sha256('p_name')} AS sha256, "
    f"{crc('p_name', 0xEDB88320)} AS crc32, {adler32('p_name')} AS adler32, "
    f"{crc('p_name', 0x82F63B78)} AS crc32c, "
    f"farm, sha384, sha512 FROM part {named('farm', fingerprint64_to_64_bytes)} "
    f"{named('sha384', sha384)} {named('sha512', sha512)}",
    "lineitem_dictionary": f"SELECT {sha256('v')} AS hash, v AS plaintext FROM (SELECT "
    "unnest([l_orderkey::VARCHAR, l_partkey::VARCHAR, l_suppkey::VARCHAR]) AS v FROM lineitem)",
    "default_algorithm": f"SELECT c_custkey, {sha256('c_name')} AS of_none, "
    f"{sha256('c_name')} AS of_empty FROM customer",
    "farm_fingerprint64_short": "SELECT c_custkey, digest AS c_mktsegment FROM ("
    + fingerprint64_to_32_bytes(
        "SELECT c_custkey, encode('k' || c_mktsegment || base64(encode(c_mktsegment))) AS m "
        "FROM customer"
    )
    + ")",
    "crc32c_long_text": f"SELECT doc_id, {crc('text', 0x82F63B78)} AS text FROM documents",
    "hash_files_csv": HASHED_ORDERS,
    "hash_files_json": HASHED_ORDERS,
    "count_by_unit": "SELECT o_orderpriority AS unit, count(*) AS record_count "
    "FROM orders GROUP BY 1",
    "split_files_csv": SPLIT_SUPPLIERS,
    "split_files_xml": SPLIT_SUPPLIERS,
    "value_types": f"SELECT o_orderkey, {sha256('d')} AS d, {sha256('b')} AS b, "
    f"{sha256('n')} AS n, "
    f"{sha256('day')} AS day, {sha256('t')} AS t FROM (SELECT o_orderkey, "
    "CASE WHEN o_orderkey >= 40000000 THEN NULL ELSE (o_orderkey / 4)::VARCHAR END AS d, "
    "(o_orderkey % 2 = 0)::VARCHAR AS b, "
    "(o_orderkey * 0.125::DECIMAL(4,3))::DECIMAL(20,3)::VARCHAR AS n, "
    "(DATE '2001-02-03' + (o_orderkey % 9999)::INTEGER)::VARCHAR AS day, "
    "regexp_replace(regexp_replace(strftime(make_timestamp(o_orderkey * 3600000001), "
    "'%Y-%m-%d %H:%M:%S.%f'), '0+$', ''), '[.]$', '') AS t FROM orders)",
    "stream_dictionary": f"SELECT {sha256('v')} AS hash, v AS plaintext FROM (SELECT DISTINCT "
    "unnest([o_orderpriority, o_orderstatus, o_custkey::VARCHAR]) AS v FROM orders)",
    "hash_files_parquet": "SELECT 'success' AS route, o_orderpriority, o_orderkey, "
    f"{sha256('o_orderstatus')} AS o_orderstatus FROM orders WHERE o_orderpriority <> '3-MEDIUM' "
    "UNION ALL SELECT DISTINCT 'failure', o_orderpriority, NULL, NULL FROM orders "
    "WHERE o_orderpriority = '3-MEDIUM'",
    "quoted_csv_files": f"SELECT doc_id, {sha256('text')} AS text FROM documents",
    "schema_of_each_file": "SELECT c_custkey, c_nationkey, "
    f"CASE WHEN c_nationkey < 12 THEN {sha256('c_name')} END AS c_name, "
    f"CASE WHEN c_nationkey >= 12 THEN {sha256('c_mktsegment')} END AS c_mktsegment, "
    "CASE WHEN c_nationkey >= 12 THEN c_acctbal END AS c_acctbal FROM customer",
    "log_records": "SELECT event_id, level, 'app.' || event_type AS source, "
    f"{sha256('m')} AS message, CASE WHEN event_id % 5 = 0 THEN chr(9) || 'at line ' || user_id || "
    "chr(10) || chr(10) || 'Caused by: ' || props END AS continued FROM (SELECT *, "
    "CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'Info' END AS level, "
    "'user ' || user_id AS m FROM events)",
    **LINEITEM,
}
