"""SQL statements for the operators that SQL can express."""

from __future__ import annotations

# The kinds in their order, with the group and least length that a match needs.
KINDS = (
    (
        "assign",
        r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])"""
        r"""|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    # Matches are whole runs, so those of fewer characters need not be found first.
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
)


def _parts(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    """The matches of a kind, each with the text before it and the group that counts."""
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"""
    SELECT n, {rank} AS rank, '{kind}' AS kind, {least} AS least, unnest(range(1, len(whole) + 1)) AS i,
        unnest(whole) AS found, unnest(kept) AS kept, unnest(gaps[:len(whole)]) AS gap
    FROM (
        SELECT n, regexp_extract_all(body, {quoted}, 0) AS whole, regexp_extract_all(body, {quoted}, {group}) AS kept,
            string_split_regex(body, {quoted}) AS gaps
        FROM d WHERE regexp_matches(body, {quoted})
    )"""


def secrets() -> str:
    parts = " UNION ALL ".join(_parts(rank, *kind) for rank, kind in enumerate(KINDS))
    text = "kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + length(found) AS BIGINT)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS body FROM documents),
parts AS ({parts}),
placed AS (
    SELECT n, rank, kind, least, found, kept,
        sum(length(gap) + length(found)) OVER (PARTITION BY n, rank ORDER BY i) - length(found) AS s
    FROM parts
),
per AS (
    SELECT n, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k, count(*) FILTER (kind = 'hex') AS h,
        string_agg({text}, ',' ORDER BY s, rank) FILTER (rank < 3) AS base, string_agg({text}, ',' ORDER BY s, rank) AS spans
    FROM placed WHERE length(kept) >= least GROUP BY n
)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (n)"""


def lines(levels: int = 12, least: int = 2, chars: int = 30) -> str:
    """Repeated runs of 1, 2, 4, ... lines by plain ranking; ``levels`` covers the longest text."""
    ranks = ["""r0 AS (SELECT doc_id, i, n, place, size, dense_rank() OVER (ORDER BY line) AS r FROM l)"""]
    for k in range(levels):
        ranks.append(
            f"""r{k + 1} AS (SELECT doc_id, i, n, dense_rank() OVER (ORDER BY r, after) AS r FROM
            (SELECT doc_id, i, n, r, lead(r, {2**k}) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM r{k}) WHERE after IS NOT NULL)"""
        )
    later = " UNION ALL ".join(
        f"SELECT doc_id, i, {2**k} AS run FROM r{k} QUALIFY row_number() OVER (PARTITION BY r ORDER BY n) > 1" for k in range(levels + 1)
    )
    return f"""
WITH body AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
each AS (SELECT doc_id, unnest(range(1, len(parts) + 1)) AS place, unnest(parts) AS line FROM body),
l AS (
    SELECT doc_id, place, trim(line, ' ') AS line, length(trim(line, ' ')) AS size,
        row_number() OVER (PARTITION BY doc_id ORDER BY place) AS i, row_number() OVER (ORDER BY doc_id, place) AS n
    FROM each WHERE trim(line, ' ') <> ''
),
{", ".join(ranks)},
later AS ({later}),
gone AS (
    SELECT DISTINCT doc_id, i FROM (
        SELECT doc_id, i FROM later JOIN l USING (doc_id, i) WHERE run = 1 AND size >= {chars}
        UNION ALL SELECT doc_id, i + unnest(range({least})) FROM later WHERE run = {least}
    )
),
runs AS (
    SELECT doc_id, count(*) AS n_deleted, list(place ORDER BY place) AS places,
        count(*) FILTER (before IS NULL OR before <> place - 1) AS n_runs
    FROM (SELECT doc_id, place, lag(place) OVER (PARTITION BY doc_id ORDER BY place) AS before FROM gone JOIN l USING (doc_id, i))
    GROUP BY doc_id
),
long AS (
    SELECT doc_id, max(run) AS longest FROM later JOIN l USING (doc_id, i) WHERE run >= {least} OR size >= {chars} GROUP BY doc_id
),
size AS (SELECT doc_id, count(*) AS n_lines FROM l GROUP BY doc_id)
SELECT b.doc_id, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(n_deleted, 0) AS INTEGER) AS n_deleted,
    CAST(coalesce(n_runs, 0) AS INTEGER) AS n_runs, CAST(coalesce(longest, 0) AS BIGINT) AS longest_copy,
    CASE WHEN n_deleted IS NULL THEN text WHEN n_deleted = n_lines THEN ''
        ELSE array_to_string([parts[j] FOR j IN range(1, len(parts) + 1) IF NOT list_contains(places, j)], chr(10)) END AS text
FROM body b LEFT JOIN runs USING (doc_id) LEFT JOIN size USING (doc_id) LEFT JOIN long USING (doc_id)"""


# Host rules with their action, and tokens and beginnings that block or allow.
HOST_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
BLOCKED = ("pills", "viagra", "casino", "poker", "porn", "xxx", "warez", "torrent", "adult", "spam-farm")


def urls() -> str:
    """Every rule against every URL, by comparing texts."""
    rules = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in HOST_RULES)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    found = [
        (rf"(^|[^0-9a-z]){w}([^0-9a-z]|$)", f"^{w}^") for w in BLOCKED
    ] + [("/adserver/", "/adserver/")]
    patterns = ", ".join(f"('{r}', '{t}', 'block')" for r, t in found)
    patterns += r", ('^([^/?#]*\.)?doubleclick\.net/', '||doubleclick.net/', 'block'), ('^([^/?#]*\.)?wikipedia\.org/', '@@||wikipedia.org/', 'allow')"
    return rf"""
WITH p AS (
    SELECT row_number() OVER () AS n, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
),
q AS (SELECT n, page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM p),
u AS (
    SELECT n, page_id, translate(raw, '{upper}', '{lower}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path,
        translate(rest, '{upper}', '{lower}') AS low
    FROM q
),
by_host AS (
    SELECT n, first(h || p ORDER BY length(h || p) DESC, length(h) DESC, a) AS rule, first(a ORDER BY length(h || p) DESC, length(h) DESC, a) AS action
    FROM u JOIN (VALUES {rules}) AS r(h, p, a) ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    GROUP BY n
),
by_pattern AS (
    SELECT n, first(t ORDER BY a, t DESC) AS pattern, first(a ORDER BY a, t DESC) AS action
    FROM u JOIN (VALUES {patterns}) AS r(x, t, a) ON regexp_matches(low, x)
    GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(b.action, t.action, 'allow') AS verdict,
    CASE WHEN rule IS NULL THEN pattern END AS pattern
FROM u LEFT JOIN by_host b USING (n) LEFT JOIN by_pattern t USING (n)"""


def resampling(buckets: int = 10_000, percent: int = 10, least: int = 20, seed: int = 2024) -> str:
    """crc32 of every distinct word from its table; the rest by plain joins and one ranking."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH RECURSIVE steps AS (
    SELECT CAST(i AS BIGINT) AS i, 0 AS k, CAST(i AS BIGINT) AS c FROM range(256) AS r(i)
    UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM steps WHERE k < 8
),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
d AS (
    SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{word}') AS words
    FROM documents
),
w AS (SELECT n, unnest(words) AS word FROM d),
b AS (
    SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{word}')) AS word FROM benchmark
),
names AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM w UNION SELECT word FROM b)),
hashed AS (
    SELECT word, xor(4294967295, list_reduce(
        list_concat([4294967295], list_transform(range(0, length(h) // 2), lambda j: CAST('0x' || substr(h, CAST(2 * j + 1 AS BIGINT), 2) AS BIGINT))),
        lambda a, x: xor(a >> 8, t[xor(a & 255, x) + 1]))) % {buckets} AS bucket
    FROM names, crc
),
counted AS (
    SELECT bucket, sum(s) AS s, sum(t) AS t FROM (
        SELECT bucket, count(*) AS s, 0 AS t FROM w JOIN hashed USING (word) GROUP BY bucket
        UNION ALL SELECT bucket, 0, count(*) FROM b JOIN hashed USING (word) GROUP BY bucket
    ) GROUP BY bucket
),
gain AS (
    SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * (sum(s) OVER () + {buckets})
        / (CAST(s + 1 AS DOUBLE) * (sum(t) OVER () + {buckets})))) AS BIGINT) AS g
    FROM counted
),
weighed AS (
    SELECT n, count(*) AS n_features, CAST(floor(CAST(sum(g) AS DOUBLE) / count(*)) AS BIGINT) AS weight
    FROM w JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY n
),
scored AS (
    SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
            + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM d LEFT JOIN weighed USING (n)
),
ranked AS (
    SELECT *, row_number() OVER (ORDER BY n_features < {least}, score DESC, doc_id NULLS LAST, n_features, weight) AS place,
        floor({percent} * count(*) FILTER (n_features >= {least}) OVER () / 100) AS quota
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {least} AND place <= quota THEN place END AS rank FROM ranked"""


def statements() -> dict[str, str]:
    return {"op2_secrets": secrets(), "op4_lines": lines(), "op12_resampling": resampling(), "op13_urls": urls()}
