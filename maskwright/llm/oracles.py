"""DuckDB SQL for the queries that SQL can express, on whole tables."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"


def _moment(demand: str, schedule) -> str:
    parts = list(zip(schedule, schedule[1:]))
    total = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in parts)
    found, done = "NULL", 0.0
    for (t0, w0), (t1, w1) in parts:
        slope, level = (w1 - w0) / (t1 - t0) / total, w0 / total
        rest = f"({demand} - {done!r}::DOUBLE)"
        root = f"sqrt(greatest(0, ({level!r}::DOUBLE) ** 2 + 2 * ({slope!r}::DOUBLE) * {rest}))"
        here = f"least({t1!r}::DOUBLE, {t0!r}::DOUBLE + 2 * {rest} / ({level!r}::DOUBLE + {root}))"
        found = here if done == 0 else f"CASE WHEN {rest} >= 0 THEN {here} ELSE {found} END"
        done += (t1 - t0) * (w0 + w1) / 2 / total
    return found


def mixing(weights, schedules, share: float, most: float) -> str:
    demand = "((words / 2 + start) / target)"
    position = " ".join(
        f"WHEN {i} THEN {_moment(demand, schedule)}" for i, schedule in enumerate(schedules)
    )
    return rf"""
WITH sized AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
    CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
    md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key
  FROM documents),
sources AS (
  SELECT src, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY src) - 1 AS place
  FROM sized GROUP BY src),
bounds AS (
  SELECT *, ({list(weights)}::DOUBLE[])[place % {len(weights)} + 1] AS weight,
    {most!r}::DOUBLE * source_size AS bound,
    {share!r}::DOUBLE * sum(source_size) OVER () AS total
  FROM sources),
levels AS (
  SELECT *, (total - coalesce(sum(bound) OVER (ORDER BY bound / weight, src
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY bound / weight, src
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM bounds),
targets AS (
  SELECT src, source_size, place, least(bound, max(level) OVER () * weight) AS target
  FROM levels),
placed AS (
  SELECT doc_id, size, source_size, place, target,
    coalesce(sum(size) OVER (PARTITION BY src ORDER BY key, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized JOIN targets USING (src)),
taken AS (
  SELECT *, greatest(0, least(size, floor(target)::BIGINT - start))::BIGINT AS words,
    greatest(0, least(size, floor(target)::BIGINT - source_size - start))::BIGINT AS again
  FROM placed)
SELECT doc_id, size::BIGINT AS size, source_size, target, (words + again)::BIGINT AS taken,
  CASE WHEN words > 0 THEN
    round(CASE place % {len(schedules)} {position} END, 6) END AS position
FROM taken"""


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _spans(kinds: dict[str, tuple[str, str]]) -> str:
    """CTEs docs (row, doc_id, text) and spans (row, place, kind, start, stop), by pattern and
    the condition on a match."""
    each = " UNION ALL ".join(
        f"""
  SELECT row, {place} AS place, '{kind}' AS kind, stop - length(value) AS start, stop FROM (
    SELECT row, value, sum(length(gap) + length(value)) OVER (PARTITION BY row ORDER BY i
      ROWS UNBOUNDED PRECEDING)::BIGINT AS stop
    FROM (SELECT row, unnest(found) AS value, unnest(gaps[1:len(found)]) AS gap,
        generate_subscripts(found, 1) AS i
      FROM (SELECT row, regexp_extract_all(text, {quoted(pattern)}) AS found,
          string_split_regex(text, {quoted(pattern)}) AS gaps FROM docs)))
  WHERE {keep}"""
        for place, (kind, (pattern, keep)) in enumerate(kinds.items())
    )
    return f"""
docs AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
spans AS MATERIALIZED ({each})"""


def secrets(kinds: dict[str, tuple[str, str]], roles: dict[str, str], base, scope: int) -> str:
    strong = ", ".join(f"'{kind}'" for kind in base)
    role = "CASE kind " + " ".join(f"WHEN '{k}' THEN '{r}'" for k, r in roles.items()) + " END"
    one = "concat_ws(':', kind, start, stop), ',' ORDER BY start, place"
    counts = ", ".join(
        f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind in base
    )
    return f"""
WITH {_spans(kinds)},
parts AS MATERIALIZED (SELECT *, {role} AS role, kind IN ({strong}) AS strong FROM spans),
reported AS (
  SELECT * FROM parts WHERE strong UNION ALL
  SELECT * FROM parts c WHERE NOT strong
    AND NOT EXISTS (SELECT 1 FROM parts b WHERE b.row = c.row AND b.strong
      AND b.start < c.stop AND c.start < b.stop)
    AND EXISTS (SELECT 1 FROM parts p WHERE p.row = c.row AND p.role <> c.role
      AND ((p.stop <= c.start AND p.stop > c.start - {scope})
        OR (p.start >= c.stop AND p.start < c.stop + {scope})
        OR ((p.role = 'endpoint' OR c.role = 'endpoint')
          AND p.start < c.stop AND c.start < p.stop)))),
found AS (
  SELECT row, {counts},
    string_agg({one}) FILTER (strong) AS base, string_agg({one}) AS spans
  FROM reported GROUP BY row)
SELECT doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in base)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN found USING (row)"""


def filter_audit() -> str:
    """Five filters of documents in all 120 orders, by the failures that documents have in
    common."""
    letters = "ABCDE"
    bits = {letter: 1 << i for i, letter in enumerate(letters)}
    bit = "CASE letter " + " ".join(f"WHEN '{c}' THEN {b}" for c, b in bits.items()) + " END"
    return rf"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM words GROUP BY text),
flagged AS (
  SELECT part, doc_id,
    CASE WHEN len(words) < 100 THEN {bits["A"]} ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN {bits["B"]} ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text)
      THEN {bits["C"]} ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN {bits["D"]} ELSE 0 END
    + CASE WHEN doc_id > first THEN {bits["E"]} ELSE 0 END AS fails
  FROM words JOIN firsts USING (text)),
marked AS (
  SELECT part, fails,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
    doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic
  FROM flagged),
groups AS MATERIALIZED (
  SELECT part, fails, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic
  FROM marked GROUP BY ALL),
orders AS (
  SELECT '' AS filter_order UNION ALL
  SELECT filter_order || letter FROM orders, (SELECT unnest(string_split('{letters}', '')) AS letter)
  WHERE NOT contains(filter_order, letter)),
steps AS MATERIALIZED (
  SELECT filter_order, step, {bit} AS own,
    list_sum([{bit.replace("letter", "x")} FOR x IN string_split(filter_order, '')][1:step - 1])
      AS before
  FROM (SELECT filter_order, step, filter_order[step] AS letter
    FROM orders, range(1, 6) AS r(step) WHERE length(filter_order) = 5)),
counted AS (
  SELECT part, filter_order, step, own,
    sum(n) FILTER (fails & (own | coalesce(before, 0)) = 0) AS kept,
    sum(n) FILTER (fails & own > 0 AND fails & coalesce(before, 0) = 0) AS removed,
    sum(n) FILTER (fails & own > 0 AND fails & coalesce(before, 0) > 0) AS redundant,
    sum(n) FILTER (fails = own) AS unique_fails,
    sum(good) FILTER (fails & own > 0 AND fails & coalesce(before, 0) = 0) AS good_lost,
    sum(toxic) FILTER (fails & own > 0 AND fails & coalesce(before, 0) = 0) AS toxic_lost
  FROM groups, steps GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, {", ".join(
    f"coalesce({c}, 0)::BIGINT AS {c}"
    for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
)},
  coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM counted"""


def _crc32(text: str) -> str:
    entries = []
    for entry in range(256):
        for _ in range(8):
            entry = (entry >> 1) ^ (0xEDB88320 if entry & 1 else 0)
        entries.append(f"{entry}::BIGINT")
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    step = f"xor(a >> 8, ([{', '.join(entries)}])[(xor(a, b) & 255) + 1])"
    start = f"list_prepend(4294967295::BIGINT, {octets})"
    return f"xor(list_reduce({start}, lambda a, b: {step}), 4294967295::BIGINT)"


def conversation_repair() -> str:
    """The cheapest edits by going through the rows once with the best edits so far for each
    role before: (cost, edits, repaired text), compared in this order."""
    far = "{'c': 1000000000, 'a': '', 'o': ''}"

    def added(state: str, cost: str, edit: str, out: str | None) -> str:
        text = f"{state}.o" + (f" || chr(10) || {out}" if out else "")
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 'o': {text}}}"

    def new(state: str, role: str) -> str:
        return added(state, "3", "I", f"'{role}:'")

    def best(*states: str) -> str:
        return f"list_min([{', '.join(states)}])"

    def only(condition: str, state: str) -> str:
        return f"CASE WHEN {condition} THEN {state} ELSE {far} END"

    start, system, user, assistant = (f"s[{i}]" for i in range(1, 5))
    user_now = best(user, *(new(s, "user") for s in (start, system, assistant)))
    opened = (
        f"list_transform([{user_now}], lambda u: "
        f"[{start}, {system}, u, {best(assistant, new('u', 'assistant'))}])[1]"
    )

    def moved(state: str, initial: str, role: str) -> list[str]:
        kept = added(state, "x.more", "K", "x.line")
        turned = added(state, "x.more + 3", "R", f"'{role}:' || x.text")
        return [only(f"NOT x.gone AND x.initial = '{initial}'", kept), only("NOT x.gone", turned)]

    t = [f"t[{i}]" for i in range(1, 5)]
    gone = [added(state, "4", "D", None) for state in t]
    to_user = [move for i in (0, 1, 3) for move in moved(t[i], "u", "user")]
    to_system = only("NOT x.gone AND x.initial = 's'", added(t[0], "x.more", "K", "x.line"))
    row = (
        f"[{gone[0]}, {best(gone[1], to_system)}, {best(gone[2], *to_user)}, "
        f"{best(gone[3], *moved(t[2], 'a', 'assistant'))}]"
    )
    after = f"list_transform([{opened}], lambda t: {row})[1]"
    begun = f"[{{'c': 0, 'a': '', 'o': ''}}, {far}, {far}, {far}]"
    final = best("t[1]", "t[4]")
    place = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal")
    return rf"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32(place)} % 20 AS damage FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
    CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN damage = 3 THEN 2 ELSE 1 END)) AS copy
  FROM given WHERE damage <> 0),
seen AS (
  SELECT *, substr(role, 1, 1) AS initial,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut
  FROM damaged),
faults AS (
  SELECT *, again AND NOT blank AS duplicate, cut AND NOT blank AND NOT again AS truncated,
    row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, role, sha256(text), again) AS place
  FROM seen),
met AS (
  SELECT *, coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial
    NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM faults),
listed AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count_if(blank) AS blank, count_if(duplicate) AS duplicate, count_if(truncated) AS truncated,
    count_if(illegal) AS illegal,
    list({{'initial': initial, 'gone': blank OR duplicate, 'more': CASE WHEN truncated THEN 3 ELSE 0 END,
      'line': role || ':' || text, 'text': text}} ORDER BY place) AS rows
  FROM met GROUP BY conv_id),
searched AS (
  SELECT *, list_reduce(rows, lambda s, x: {after}, {begun}) AS s FROM listed),
closed AS (
  SELECT *, {opened} AS t FROM searched),
ended AS (SELECT *, {final} AS best FROM closed)
SELECT c.conv_id, {", ".join(f"coalesce({name}, 0)::BIGINT AS {name}" for name in counts)},
  coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit,
  sha256(coalesce(substr(best.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN ended e ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""
