"""Registered queries of this folder, with DuckDB twins where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflux.llm.ann import nearest
from skyflux.llm.bpe import bpe_encode
from skyflux.llm.common import table
from skyflux.llm.conversations import damage, repair
from skyflux.llm.exact_dedup import exact_dedup
from skyflux.llm.licenses import TEMPLATES, THRESHOLD, WORD, license_scan
from skyflux.llm.lm_score import MU, UNIT, lm_scores
from skyflux.llm.mixing import TARGETS, TOPICS, mix_decisions
from skyflux.llm.odd_sketch import near_duplicates
from skyflux.llm.shingle_join import shingle_components
from skyflux.llm.token_counts import token_counts
from skyflux.llm.toxicity import classify
from skyflux.llm.url_filter import host, page_key, temporal_url_filter
from skyflux.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- 1: URL filter
def list_entries(pages: DataFrame) -> DataFrame:
    """A dated block list for the pages' own hosts and pages: each host gets
    three entries over the year 2024, a page one when its digest starts with 0-3."""
    num = lambda c, at: F.conv(F.substring(c, at, 6), 16, 10).cast("int")
    p = pages.select(host("url").alias("h"), page_key("url").alias("k"))
    hosts = (p.filter("h != ''").select("h").distinct()
             .withColumn("i", F.explode(F.array(F.lit(1), F.lit(7), F.lit(13))))
             .withColumn("m", F.md5("h"))
             .select(F.lit("domain").alias("kind"), F.col("h").alias("value"),
                     F.when(F.expr("conv(substring(m, i, 6), 16, 10) % 3 = 0"), "allow").otherwise("block").alias("action"),
                     F.expr("date_add(DATE'2024-01-01', cast(conv(substring(m, i, 6), 16, 10) % 366 as int))").alias("effective")))
    urls = (p.filter("h != ''").select("k").distinct().withColumn("m", F.md5("k"))
            .filter(F.col("m") < "4")
            .select(F.lit("page").alias("kind"), F.col("k").alias("value"),
                    F.when(num("m", 3) % 2 == 0, "allow").otherwise("block").alias("action"),
                    F.expr("date_add(DATE'2024-01-01', cast(conv(substring(m, 9, 6), 16, 10) % 366 as int))").alias("effective")))
    return hosts.unionByName(urls)


@query("op1_temporal_url_filter", r"""
WITH cap AS (
  SELECT page_id, url, CAST(DATE '2024-01-01' + CAST((page_id * 37) % 366 AS INTEGER) AS DATE) AS fetched_at,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1)) AS h,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^?#]*)', 1) AS hp FROM pages),
c AS (SELECT *, regexp_replace(h || regexp_replace(hp, '^[^/]*', ''), '/+$', '') AS k FROM cap),
hosts AS (SELECT DISTINCT h, md5(h) AS m FROM c WHERE h <> ''),
e0 AS (
  SELECT 'domain' AS kind, h AS value, CAST('0x' || substr(m, i, 6) AS BIGINT) AS x
  FROM hosts CROSS JOIN (VALUES (1), (7), (13)) t(i)),
e AS (
  SELECT kind, value, CASE WHEN x % 3 = 0 THEN 'allow' ELSE 'block' END AS action,
         CAST(DATE '2024-01-01' + CAST(x % 366 AS INTEGER) AS DATE) AS eff FROM e0
  UNION ALL
  SELECT 'page', k, CASE WHEN CAST('0x' || substr(md5(k), 3, 6) AS BIGINT) % 2 = 0 THEN 'allow' ELSE 'block' END,
         CAST(DATE '2024-01-01' + CAST(CAST('0x' || substr(md5(k), 9, 6) AS BIGINT) % 366 AS INTEGER) AS DATE)
  FROM (SELECT DISTINCT k FROM c WHERE h <> '') WHERE md5(k) < '4'),
d AS (SELECT kind, value, eff, max(action) AS action FROM e GROUP BY ALL),
iv AS (SELECT *, lead(eff) OVER (PARTITION BY kind, value ORDER BY eff) AS till FROM d),
m AS (
  SELECT c.page_id, iv.kind, iv.value, iv.eff, iv.action,
         CASE WHEN iv.kind = 'page' THEN 1000 ELSE len(string_split(iv.value, '.')) END AS r
  FROM c JOIN iv ON ((iv.kind = 'page' AND iv.value = c.k)
                  OR (iv.kind = 'domain' AND (iv.value = c.h OR ends_with(c.h, '.' || iv.value))))
    AND iv.eff <= c.fetched_at AND (iv.till IS NULL OR c.fetched_at < iv.till)
  WHERE c.h <> ''),
b AS (SELECT page_id, CAST(count(*) AS INTEGER) AS matched, arg_max(kind, r) AS rule_kind, arg_max(value, r) AS rule_value,
             arg_max(eff, r) AS rule_since, arg_max(action, r) AS action FROM m GROUP BY page_id)
SELECT c.page_id, c.url, c.fetched_at, coalesce(b.matched, 0) AS matched, b.rule_kind, b.rule_value, b.rule_since,
       coalesce(b.action = 'block', false) AS blocked
FROM c LEFT JOIN b USING (page_id)
""")
def op1_temporal_url_filter(spark, sf_dir):
    """Every capture of `pages` against the entries in force when it was fetched."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    caps = pages.withColumn("fetched_at", F.expr("date_add(DATE'2024-01-01', cast((page_id * 37) % 366 as int))"))
    return temporal_url_filter(caps, list_entries(pages))


# --------------------------------------------------------- 2: nearest neighbours
@query("op2_vector_graph")
def op2_vector_graph(spark, sf_dir):
    """The 20 nearest found for every vector whose id is divisible by 20."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(v, v.filter("vec_id % 20 = 0"))


# -------------------------------------------------------------- 3: toxicity
@query("op3_toxicity_chain")
def op3_toxicity_chain(spark, sf_dir):
    """Probabilities of the toxicity categories for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return classify(docs, table(spark, sf_dir, "labels"))


# ------------------------------------------------------ 4: n-gram Jaccard join
def _links_sql(width: int, percent: int, kept: str = "") -> str:
    """All pairs of documents with a common shingle, their links, and everything reachable from each document."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS ws
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= {width} THEN list_transform(range(1, len(ws) - {width - 2}), lambda i: array_to_string(ws[i:i + {width - 1}], ' '))
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS i, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.i),
c AS (SELECT i, min(root) AS component_id FROM r GROUP BY i)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id{kept} FROM w LEFT JOIN n USING (doc_id) JOIN c ON c.i = w.doc_id
"""


@query("op4_ngram_jaccard", _links_sql(5, 75))
def op4_ngram_jaccard(spark, sf_dir):
    """Every document with the size of its shingle set and its component of links."""
    return shingle_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


# ------------------------------------------------------------- 5, 6: tokenizers
@query("op5_byte_bpe")
def op5_byte_bpe(spark, sf_dir):
    """Digests of the ids of every document and of what they decode to."""
    import public_tokenizers as P
    vocab = P.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_encode(docs, vocab, P.PATTERN, decoded_col="decoded").select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op6_token_counts")
def op6_token_counts(spark, sf_dir):
    """Bytes and tokens of every document."""
    import public_tokenizers as P
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, P.path("byte_bpe_50k.json"), P.PATTERN)


# -------------------------------------------------------------- 9: exact dedup
@query("op9_exact_dedup", r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
""")
def op9_exact_dedup(spark, sf_dir):
    """Every document with the row of its text that stays."""
    return exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


# ------------------------------------------------------------------ 10: mixing
def _mixing_sql() -> str:
    """The same raking, step by step: one axis a step, cells as rows."""
    axes = {"s": "source", "l": "lang", "t": "topic"}
    named = {a: [k for k in TARGETS.marginals[n] if k != "*"] for a, n in axes.items()}
    lit = lambda ks: ", ".join(f"'{k}'" for k in ks)
    topic = " ".join(f"WHEN regexp_matches(x, '{p}') THEN '{n}'" for n, p in TOPICS)
    goal = {a: "CASE " + a + " " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in TARGETS.marginals[n].items()) + " ELSE 0.0 END"
            for a, n in axes.items()}
    norm = ", ".join(f"CAST({goal[a]} AS DOUBLE) / (SELECT sum(CAST({goal[a]} AS DOUBLE)) FROM (SELECT DISTINCT {a} FROM c)) AS g{a}"
                     for a in axes)
    step = " ".join(f"WHEN {i} THEN w * (g{a} / nullif(sum(w) OVER (PARTITION BY {a}), 0))" for i, a in enumerate(axes))
    return rf"""
WITH RECURSIVE x AS (SELECT doc_id, source, lang, coalesce(text, '') AS x FROM documents),
d AS (SELECT doc_id, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS n,
        CASE WHEN source IN ({lit(named['s'])}) THEN source ELSE '*' END AS s,
        CASE WHEN lang IN ({lit(named['l'])}) THEN lang ELSE '*' END AS l,
        CASE {topic} ELSE 'prose' END AS t FROM x),
c AS (SELECT s, l, t, CAST(sum(n) AS DOUBLE) AS n FROM d GROUP BY s, l, t HAVING sum(n) > 0),
it AS (
  SELECT 0 AS i, s, l, t, n, {norm}, n / sum(n) OVER () AS w FROM c
  UNION ALL
  SELECT i + 1, s, l, t, n, gs, gl, gt, coalesce(CASE i % 3 {step} END, 0) FROM it WHERE i < {3 * TARGETS.rounds}),
r AS (SELECT s, l, t, n, w, w / n AS q FROM it WHERE i = {3 * TARGETS.rounds}),
o AS (SELECT *, row_number() OVER v AS k, coalesce(sum(n) OVER (v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done,
             sum(w) OVER (v ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
             least({TARGETS.keep} * sum(n) OVER (), sum(CASE WHEN q > 0 THEN n ELSE 0 END) OVER ()) AS budget
      FROM r WINDOW v AS (ORDER BY q DESC, s, l, t)),
z AS (SELECT arg_min((budget - done) / rest, k) FILTER (rest > 0 AND q * (budget - done) / rest <= 1 + 1e-12) AS f FROM o),
p AS (SELECT s, l, t, least(1.0, q * (SELECT f FROM z)) AS p FROM r),
u AS (SELECT d.*, coalesce(p.p, 1.0) AS p,
             CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '|{TARGETS.seed}'), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656 AS u
      FROM d LEFT JOIN p USING (s, l, t))
SELECT doc_id, CAST(n AS BIGINT) AS mix_tokens, s AS mix_source, l AS mix_lang, t AS mix_topic,
       floor(p * 1e8 + 0.5) / 1e8 AS mix_p, u < p AS mix_kept FROM u
"""


@query("op10_source_mixing", _mixing_sql())
def op10_source_mixing(spark, sf_dir):
    """Every document with its cell, its calibrated probability and whether it was drawn."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mix_decisions(docs, TARGETS).select("doc_id", "mix_tokens", "mix_source", "mix_lang", "mix_topic",
                                     (F.floor(F.col("mix_p") * 1e8 + 0.5).cast("double") / F.lit(1e8)).alias("mix_p"), "mix_kept")


# ------------------------------------------------------------------ 8: licences
def _license_sql() -> str:
    """All units against all templates, without the size bounds."""
    quote = lambda x: x.replace("'", "''")
    rows = ", ".join(f"('{k}', {i}, '{quote(t)}')" for k, ts in TEMPLATES.items() for i, t in enumerate(ts))
    low = lambda c: f"translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    wl = lambda c: f"list_transform(regexp_extract_all({low(c)}, '{WORD}'), lambda w: regexp_replace(w, '\\.+$', ''))"
    grams = lambda k, src: (
        f"SELECT {k}, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS g FROM {src}")
    return rf"""
WITH x AS (SELECT DISTINCT doc_id, coalesce(text, '') AS x FROM documents),
u AS (SELECT DISTINCT doc_id, unnest(list_concat(regexp_split_to_array(x, '[\n\r]+'),
        regexp_split_to_array(regexp_replace(x, '([.!?])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'), '[\n\r]+'), [x])) AS unit FROM x),
uw AS (SELECT doc_id, unit, {wl('unit')} AS w FROM u),
ug AS ({grams('doc_id, unit', 'uw WHERE len(w) >= 1 AND len(w) <= 200')}),
uc AS (SELECT doc_id, unit, g, count(*) AS c FROM ug GROUP BY ALL),
us AS (SELECT doc_id, unit, sum(c) AS n FROM uc GROUP BY ALL),
t AS (SELECT license, template, {wl('txt')} AS w FROM (VALUES {rows}) v(license, template, txt)),
tc AS (SELECT license, template, g, count(*) AS c FROM ({grams('license, template', 't')}) GROUP BY ALL),
ts AS (SELECT license, template, sum(c) AS n FROM tc GROUP BY ALL),
b AS (SELECT uc.doc_id, uc.unit, tc.license, tc.template, sum(least(uc.c, tc.c)) AS shared FROM uc JOIN tc USING (g) GROUP BY ALL),
m AS (SELECT b.*, CAST(2 * shared AS DOUBLE) / CAST(us.n + ts.n AS DOUBLE) AS dice
      FROM b JOIN us USING (doc_id, unit) JOIN ts USING (license, template))
SELECT doc_id, license, max(dice) AS dice, CAST(arg_max(template, [dice, -template]) AS INTEGER) AS template,
       count(DISTINCT unit) AS n_units
FROM m WHERE dice >= {THRESHOLD} GROUP BY doc_id, license
"""


@query("op8_license_scan", _license_sql())
def op8_license_scan(spark, sf_dir):
    """Licences named in each document."""
    return license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


# --------------------------------------------------------------- 7: LM scores
def _weight_sql(p: str) -> str:
    """log10 in units, as a whole number."""
    return f"CAST(floor(log10({p}) * CAST({UNIT!r} AS DOUBLE) + 0.5) AS BIGINT)"


def _score_sql(total: str) -> str:
    """A sum of units as the nearest double."""
    return f"(CAST({total} // 16777216 AS DOUBLE) * 16777216 + CAST({total} % 16777216 AS DOUBLE)) / CAST({UNIT!r} AS DOUBLE)"


@query("op7_backoff_lm", rf"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
w AS (SELECT doc_id, list_append(list_transform(regexp_extract_all(x, '[^\x20\x09-\x0D]+'), lambda v: 'w' || v), 'end') AS ws FROM d),
t AS (SELECT doc_id, unnest(ws) AS w, unnest(list_prepend('start', ws[1:len(ws) - 1])) AS v,
        unnest(list_concat([NULL, 'start'], ws[1:len(ws) - 2])[1:len(ws)]) AS u FROM w),
-- CRC-32 of the id's text: reflected polynomial 0xEDB88320, bit by bit
ids AS (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents),
held AS (SELECT doc_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(s) * 9 + 1), lambda i:
           CASE WHEN i % 9 = 1 THEN 1000000 + CAST(ord(s[CAST(ceil(i / 9.0) AS INTEGER)]) AS BIGINT) ELSE -1 END)),
         lambda c, o: CASE WHEN o >= 0 THEN xor(c, o - 1000000) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END),
         CAST(4294967295 AS BIGINT)) % 10 = 0 AS held_out FROM ids),
tt AS (SELECT t.*, held_out FROM t JOIN held USING (doc_id)),
u AS (SELECT w, count(*) AS c FROM tt WHERE NOT held_out GROUP BY w),
b AS (SELECT v, w, count(*) AS c FROM tt WHERE NOT held_out GROUP BY v, w),
cv AS (SELECT v, sum(c) AS c FROM b GROUP BY v),
b3 AS (SELECT u, v, w, count(*) AS c FROM tt WHERE NOT held_out AND u IS NOT NULL GROUP BY u, v, w),
cuv AS (SELECT u, v, sum(c) AS c FROM b3 GROUP BY u, v),
k AS (SELECT sum(c) AS n, count(*) AS types FROM u),
s AS (SELECT tt.doc_id, tt.held_out, u.c IS NOT NULL AS known,
        (coalesce(u.c, 0) + CAST(0.1 AS DOUBLE)) / (k.n + CAST(0.1 AS DOUBLE) * (k.types + 1)) AS p, coalesce(b.c, 0) AS cb, coalesce(cv.c, 0) AS cc, k.n,
        coalesce(b3.c, 0) AS c3, CASE WHEN tt.u IS NOT NULL THEN coalesce(cuv.c, 0) END AS cc3
      FROM tt CROSS JOIN k LEFT JOIN u ON u.w = tt.w LEFT JOIN b ON b.v = tt.v AND b.w = tt.w LEFT JOIN cv ON cv.v = tt.v
      LEFT JOIN b3 ON b3.u = tt.u AND b3.v = tt.v AND b3.w = tt.w LEFT JOIN cuv ON cuv.u = tt.u AND cuv.v = tt.v)
SELECT doc_id, held_out, n_tokens, n_known, train_tokens, {_score_sql('base')} AS base_score, {_score_sql('total')} AS score
FROM (
  SELECT doc_id, held_out, count(*) AS n_tokens, CAST(sum(CAST(known AS INTEGER)) AS BIGINT) AS n_known, CAST(any_value(n) AS BIGINT) AS train_tokens,
         sum({_weight_sql('p')}) AS base,
         sum(CASE WHEN c3 > 0 THEN {_weight_sql('(c3 + mu * p2) / (cc3 + mu)')}
           ELSE CASE WHEN cc3 > 0 THEN {_weight_sql('mu / (cc3 + mu)')} ELSE 0 END
              + CASE WHEN cb > 0 THEN {_weight_sql('p2')} ELSE {_weight_sql('mu / (cc + mu)')} + {_weight_sql('p')} END END) AS total
  FROM (SELECT *, (cb + mu * p) / (cc + mu) AS p2 FROM (SELECT *, CAST({MU} AS DOUBLE) AS mu FROM s)) GROUP BY doc_id, held_out)
""")
def op7_backoff_lm(spark, sf_dir):
    """Log-probability of every document under a model of nine tenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_scores(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0)


# -------------------------------------------------------------- 11: whitening
@query("op11_whitening")
def op11_whitening(spark, sf_dir):
    """Every vector on the leading components of the vectors' covariance."""
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


# --------------------------------------------------- 12: conversation repair
def _repair_sql() -> str:
    """Row by row from the front: for each of the four states the cheapest way there, of equal costs the one with
    the least edits; inserts between rows, then the row's edit."""
    far = 1 << 40
    best = lambda *ways: f"list_min([{', '.join(ways)}])"
    way = lambda cost, edit, line, old: (  # noqa: E731  (cost, edits, repaired lines)
        f"{{'c': {old}.c + {cost}, 'e': {old}.e || '{edit}', 'l': list_concat({old}.l, {line})}}")
    none = f"{{'c': {far}, 'e': '', 'l': CAST([] AS VARCHAR[])}}"
    ins = lambda role, old: way(3, "I", f"['{role}:']", old)
    # closed under inserts: nothing/s -> u, u -> a, a -> u
    u1 = best("q2", ins("user", "q0"), ins("user", "q1"), ins("user", "q3"))
    a1 = best("q3", ins("assistant", "q2"), ins("assistant", f"({best('q2', ins('user', 'q0'), ins('user', 'q1'))})"))
    drop = lambda q: way(4, "D", "[]", q)
    more = "(CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END)"
    keep = lambda initial, q: f"CASE WHEN left(role, 1) = '{initial}' AND NOT must THEN {way(more, 'K', '[role || chr(58) || text]', q)} ELSE {none} END"
    redo = lambda role, q: f"CASE WHEN NOT must THEN {way(f'3 + {more}', 'R', f'[{chr(39)}{role}:{chr(39)} || text]', q)} ELSE {none} END"
    crc = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(s) * 9 + 1), lambda i:
           CASE WHEN i % 9 = 1 THEN 1000000 + CAST(ord(s[CAST(ceil(i / 9.0) AS INTEGER)]) AS BIGINT) ELSE -1 END)),
         lambda c, o: CASE WHEN o >= 0 THEN xor(c, o - 1000000) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END),
         CAST(4294967295 AS BIGINT)) % 20"""
    space = r"[\x20\x09-\x0D]"
    return rf"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
k AS (SELECT *, {crc} AS k FROM src),
dam AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE k <> 0),
num AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         regexp_replace(text, '{space}+$', '') AS body FROM dam),
f AS (
  SELECT *, CASE WHEN regexp_replace(body, '{space}', '', 'g') = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM num),
r AS (SELECT *, fault IN ('blank', 'duplicate') AS must FROM f),
ids AS (SELECT DISTINCT conv_id FROM conversations),
dp AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'e': '', 'l': CAST([] AS VARCHAR[])}} AS q0, {none} AS q1, {none} AS q2, {none} AS q3 FROM ids
  UNION ALL
  SELECT conv_id, i + 1, {drop('q0')}, {best(drop('q1'), keep('s', 'q0'))},
         {best(drop('u'), keep('u', 'q0'), keep('u', 'q1'), keep('u', 'a'), redo('user', 'q0'), redo('user', 'q1'), redo('user', 'a'))},
         {best(drop('a'), keep('a', 'u'), redo('assistant', 'u'))}
  FROM (SELECT dp.conv_id, dp.i, q0, q1, {u1} AS u, {a1} AS a, r.role, r.text, r.fault, r.must
        FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1)),
fin AS (
  SELECT conv_id, {best('q0', a1)} AS z FROM dp
  WHERE i = (SELECT count(*) FROM r WHERE r.conv_id IS NOT DISTINCT FROM dp.conv_id)),
agg AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
SELECT fin.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, z.c AS cost, z.e AS audit, sha256(array_to_string(z.l, chr(10))) AS repaired_sha256
FROM fin LEFT JOIN agg ON agg.conv_id IS NOT DISTINCT FROM fin.conv_id
"""


@query("op12_conversation_repair", _repair_sql())
def op12_conversation_repair(spark, sf_dir):
    """Every conversation, damaged by checksum, with its cheapest repair."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(damage(rows), rows)


# ------------------------------------------------- 13: MinHash near-dedup
@query("op13_odd_sketch_dedup", _links_sql(4, 80, ", w.doc_id = c.component_id AS kept"))
def op13_odd_sketch_dedup(spark, sf_dir):
    """Every document with its component of near duplicates and whether it stays."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
