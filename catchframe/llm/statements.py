"""SQL counterparts of the URL filter, the manifest and the conversation repair."""

from __future__ import annotations

from catchframe.llm.urlfilter import BIN, END, FOLDS, ORDER, RULES, SCALE, START, SYMBOLS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def crc32(text: str) -> str:
    """CRC-32 of a text's bytes, bit by bit."""
    bits = (
        f"list_transform(range(0, 4 * length(hex({text}))), lambda k: "
        f"((('0x' || substr(hex({text}), (2 * (k // 8) + 1)::INT, 2))::INT >> (k % 8)::INT) & 1)::BIGINT)"
    )
    step = "xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), lambda c, x: {step}), 4294967295)"


def _lower(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


def _url_sql() -> str:
    rules = sorted(RULES, key=lambda r: (-len(r[0]), r[0]))
    fits = []
    for rule, _ in rules:
        host, slash, path = rule.partition("/")
        fits.append(f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{path}'))")
    pick = lambda at: "CASE " + " ".join(f"WHEN {f} THEN '{r[at]}'" for f, r in zip(fits, rules)) + " END"
    pad = f"repeat(chr({ord(START)}), {ORDER}) || t || chr({ord(END)})"
    out = [f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS t, strpos(url, '://') AS cut, substr(url, strpos(url, '://') + 3) AS rest FROM pages),
h AS (SELECT page_id, t, coalesce(CASE WHEN cut > 0 THEN {_lower("regexp_extract(rest, '^([^/?#]*)', 1)")} END, '') AS host,
  coalesce(CASE WHEN cut > 0 THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) END, '') AS path FROM p),
r AS MATERIALIZED (SELECT *, {pick(0)} AS rule, {pick(1)} AS ruled, {crc32("t")} % {FOLDS} AS fold, row_number() OVER () AS id FROM h),
g AS MATERIALIZED (SELECT id, ruled, fold, substr({pad}, unnest(range(1, length(t) + 2))::INT, {ORDER + 1}) AS gram FROM r),
c AS MATERIALIZED (SELECT gram, count(*) FILTER (WHERE fold <> 0 AND ruled = 'allow') AS good, count(*) FILTER (WHERE fold <> 0 AND ruled = 'block') AS bad FROM g GROUP BY gram)"""]
    for k in range(ORDER + 1):
        if k == 0:
            last = f"SELECT *, 1.0::DOUBLE / {SYMBOLS} AS q_good, 1.0::DOUBLE / {SYMBOLS} AS q_bad FROM n0"
        else:
            last = f"SELECT n{k}.*, l.p_good AS q_good, l.p_bad AS q_bad FROM n{k} JOIN p{k - 1} l ON substr(n{k}.gram, 2) = l.gram"
        value = ", ".join(
            f"CASE WHEN n_{x} = 0 THEN q_{x} ELSE ({x} + t_{x} * q_{x}) / (n_{x} + t_{x}) END AS p_{x}" for x in ("good", "bad")
        )
        out.append(f""",
e{k} AS (SELECT substr(gram, {ORDER + 1 - k}, {k + 1}) AS gram, sum(good)::DOUBLE AS good, sum(bad)::DOUBLE AS bad FROM c GROUP BY 1),
n{k} AS (SELECT *, sum(good) OVER w AS n_good, sum(bad) OVER w AS n_bad, sum((good > 0)::INT)::DOUBLE OVER w AS t_good, sum((bad > 0)::INT)::DOUBLE OVER w AS t_bad
  FROM e{k} WINDOW w AS (PARTITION BY substr(gram, 1, {k}))),
p{k} AS MATERIALIZED (SELECT gram, {value} FROM ({last}))""".replace("::DOUBLE OVER w", " OVER w"))
    out.append(f""",
v AS (SELECT gram, round((ln(p_good) - ln(p_bad)) * {SCALE})::BIGINT AS ratio FROM p{ORDER}),
s AS (SELECT id, floor(sum(ratio) / count(*)) AS score FROM g JOIN v USING (gram) GROUP BY id),
b AS MATERIALIZED (SELECT r.*, floor(score / {BIN})::BIGINT AS bin FROM r JOIN s USING (id)),
k AS (SELECT bin, count(*) FILTER (WHERE ruled = 'allow') AS good, count(*) FILTER (WHERE ruled = 'block') AS bad FROM b WHERE fold = 0 AND ruled IS NOT NULL GROUP BY bin),
e AS (SELECT * FROM k UNION ALL SELECT max(bin) + 1, 0, 0 FROM k),
z AS (SELECT bin, sum(good) OVER () AS goods, sum(bad) OVER () AS bads, coalesce(sum(good) OVER u, 0) AS lost, coalesce(sum(bad) OVER u, 0) AS stopped
  FROM e WHERE bin IS NOT NULL WINDOW u AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
y AS (SELECT bin, lost::DOUBLE / goods::DOUBLE + (bads - stopped)::DOUBLE / bads::DOUBLE AS cost FROM z WHERE goods > 0 AND bads > 0),
x AS (SELECT coalesce((SELECT bin FROM y WHERE cost = (SELECT min(cost) FROM y) ORDER BY abs(bin), bin LIMIT 1), 0) AS least)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN bin >= least THEN 'allow' ELSE 'block' END) AS verdict FROM b, x
""")
    return "".join(out)


def _merkle_sql(levels: int = 7, tops: int = 6) -> str:
    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"

    beside = "string_agg(digest, '') OVER (PARTITION BY tree, n // 16 ORDER BY n ROWS BETWEEN"
    out = [f"""
WITH g AS (SELECT source AS named, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM documents)),
l AS (SELECT doc_id, tree, {leaf('text')} AS leaf, CASE WHEN {crc32('doc_id::VARCHAR')} % 5 = 0 THEN {leaf(_lower('text'))} ELSE leaf END AS own
  FROM documents d JOIN g ON source IS NOT DISTINCT FROM named),
a0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM l),
t0 AS (SELECT tree, place AS n, leaf AS digest FROM a0)"""]
    for k in range(levels + tops):
        if k == levels:
            out.append(f",\nt{k} AS (SELECT 0 AS tree, tree AS n, digest FROM u{k})")
        out.append(f""",
s{k} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY tree) AS size, coalesce({beside} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
  coalesce({beside} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM t{k}),
{'u' if k + 1 == levels else 't'}{k + 1} AS MATERIALIZED (SELECT tree, n // 16 AS n, CASE WHEN max(size) = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY n)) END AS digest
  FROM s{k} GROUP BY tree, n // 16)""")
    last = levels + tops
    out.append(",\nf0 AS (SELECT *, own AS x, '' AS proof, place AS n FROM a0)")
    for k in range(last):
        at, on = ("f.n // 16", "f.tree = s.tree AND f.n = s.n") if k < levels else ("f.n // 16", "f.n = s.n")
        if k == levels:
            out.append(f",\nf{k}t AS (SELECT * EXCLUDE (n), tree AS n FROM f{k})")
        source = f"f{k}t" if k == levels else f"f{k}"
        out.append(f""",
f{k + 1} AS (SELECT f.doc_id, f.tree, f.leaf, {at} AS n, CASE WHEN size > 1 THEN sha256(before || x || after) ELSE x END AS x,
  proof || CASE WHEN size > 1 THEN before || after ELSE '' END AS proof FROM {source} f JOIN s{k} s ON {on})""")
    out.append(f"""
SELECT doc_id, leaf, u.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256, x AS folded_root, x = t.digest AS verified
FROM f{last} f JOIN u{levels} u ON f.tree = u.tree, t{last} t
""")
    return "".join(out)


def _add(value: str, cost: str, letter: str) -> str:
    """A way is nine digits of cost and its letters, so that the least text is the cheapest way."""
    return f"(lpad((substr({value}, 1, 9)::INT + {cost})::VARCHAR, 9, '0') || substr({value}, 10) || '{letter}')"


def _dialog_sql() -> str:
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    key = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    more = "CASE WHEN fault = 't' THEN 5 ELSE 0 END"
    keep = {w: f"CASE WHEN free AND initial = '{w}' THEN %s END" for w in "sua"}
    change = "CASE WHEN free THEN %s END"
    steps = {
        "e": _add("w.e", "2", "D"),
        "s": f"least({_add('w.s', '2', 'D')}, {keep['s'] % _add('w.e', more, 'K')})",
        "u": f"least({_add('w.u', '2', 'D')}, " + ", ".join(
            [keep["u"] % _add(f"w.{x}", more, "K") for x in "esa"] + [change % _add(f"w.{x}", f"1 + {more}", "R") for x in "esa"]
        ) + ")",
        "a": f"least({_add('w.a', '2', 'D')}, {keep['a'] % _add('w.u', more, 'K')}, {change % _add('w.u', f'1 + {more}', 'R')})",
    }
    put_u = "least(u, " + ", ".join(_add(x, "5", "I") for x in "esa") + ")"
    return f"""
WITH RECURSIVE k AS (SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32(key)} % 20 AS hit FROM conversations),
r AS (SELECT c, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
  CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(0, CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i FROM r),
b AS (SELECT *, rtrim(text, {blanks}) AS bare, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again,
  CASE WHEN substr(role, 1, 1) IN ('s', 'u', 'a') THEN substr(role, 1, 1) ELSE 'x' END AS initial FROM o),
f AS MATERIALIZED (SELECT *, CASE WHEN bare = '' THEN 'b' WHEN again THEN 'd' WHEN right(bare, 1) IN ('.', '!', '?') THEN '-' ELSE 't' END AS fault,
  NOT (bare = '' OR again) AS free, lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS pair FROM b),
w AS (SELECT DISTINCT c, 0::BIGINT AS i, '000000000' AS e, NULL::VARCHAR AS s, '000000005I' AS u, '000000010II' AS a FROM f
  UNION ALL
  SELECT c, i, e, s, put AS u, least(a, {_add('put', '5', 'I')}) AS a FROM (SELECT *, {put_u} AS put FROM (
    SELECT w.c, f.i, {steps['e']} AS e, {steps['s']} AS s, {steps['u']} AS u, {steps['a']} AS a FROM w JOIN f ON w.c = f.c AND f.i = w.i + 1))),
n AS (SELECT c, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count_if(fault = 'b')::BIGINT AS blank,
  count_if(fault = 'd')::BIGINT AS duplicate, count_if(fault = 't')::BIGINT AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY c),
p AS MATERIALIZED (SELECT n.*, least(w.e, w.a) AS way FROM n JOIN w ON n.c = w.c AND n.rows = w.i),
x AS (SELECT c, unnest(range(1, length(way) - 8)) AS pos, substr(way, pos::INT + 9, 1) AS edit FROM p),
y AS (SELECT *, sum((edit <> 'I')::INT) OVER t AS row, sum((edit <> 'D')::INT) OVER t AS place FROM x WINDOW t AS (PARTITION BY c ORDER BY pos)),
z AS (SELECT y.*, f.role, f.text, max((place = 1 AND edit = 'K' AND initial = 's')::INT) OVER (PARTITION BY y.c) AS opens FROM y LEFT JOIN f ON y.c = f.c AND y.row = f.i AND edit <> 'I'),
q AS (SELECT c, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - opens) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
  CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY pos) AS told FROM z WHERE edit <> 'D' GROUP BY c)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(substr(way, 1, 9)::BIGINT, 0) AS cost, coalesce(substr(way, 10), '') AS audit, sha256(coalesce(told, '')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM k) d LEFT JOIN p ON d.c = p.c LEFT JOIN q ON d.c = q.c
"""


URL_SQL = _url_sql()
MERKLE_SQL = _merkle_sql()
DIALOG_SQL = _dialog_sql()
