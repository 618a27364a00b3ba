"""Queries of the training-data operators with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from gridframe.llm import (
    decontaminate,
    infill,
    langid,
    merkle,
    pagetext,
    partenum,
    permutation,
    pieces,
    reputation,
    runindex,
    substring,
    tokencount,
    toxicity,
    vocabulary,
)
from gridframe.llm.textbytes import small_batches

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    if name == "documents":
        small_batches(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


# -- URL filters -----------------------------------------------------------------------------------------------------

URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def _level_sql(level: str, keys: str, prior: str, source: str) -> str:
    """One level of shrinkage: groups, fitted strength, posterior."""
    return f"""g_{level} AS (SELECT {keys}, sum(n) AS n, sum(bad) AS bad FROM counts GROUP BY {keys}),
  t_{level} AS (SELECT count(*) AS k, CAST(coalesce(sum(n), 0) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad,
    sum(CAST(n AS DOUBLE) * n) AS n2, sum(CAST(bad AS DOUBLE) * bad / n) AS b2n FROM g_{level} WHERE n > 0),
  u_{level} AS (SELECT *, (bad + 1) / (n + 2) AS mu FROM t_{level}),
  v_{level} AS (SELECT mu, CASE WHEN k > 1 AND n - n2 / n > 0
    THEN (b2n - 2 * mu * bad + mu * mu * n - (k - 1) * mu * (1 - mu)) / (n - n2 / n) END AS between_var FROM u_{level}),
  s_{level} AS (SELECT mu, greatest(1.0, least(1e6, coalesce(CASE WHEN between_var > 0
    THEN mu * (1 - mu) / between_var - 1 END, 1e6))) AS m FROM v_{level}),
  r_{level} AS (SELECT g.*, s.m, (s.m * {prior} + g.bad) / (s.m + g.n) AS rate FROM g_{level} g {source}, s_{level} s)"""


_RULE_SQL = " ".join(
    f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'"
    for _, r in sorted(URL_RULES, key=lambda x: -len(x[1]))
)


@query("op7_url_reputation", f"""WITH a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
  p AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{reputation.UPPER}', '{reputation.LOWER}') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM a),
  counts AS (SELECT host, regexp_extract(host, '([^.]*[.])?[^.]*$') AS domain,
    regexp_extract(host, '[^.]*$') AS suffix, count(quality) AS n, coalesce(sum(1 - quality), 0) AS bad
    FROM p LEFT JOIN labels l ON l.doc_id = p.page_id GROUP BY host),
  {_level_sql('suffix', 'suffix', 's.mu', '')},
  {_level_sql('domain', 'domain, suffix', 'q.rate', 'JOIN r_suffix q USING (suffix)')},
  {_level_sql('host', 'host, domain', 'q.rate', 'JOIN r_domain q USING (domain)')},
  h AS (SELECT host, rate - 1.645 * sqrt(rate * (1 - rate) / (m + n + 1)) AS lower_bound FROM r_host),
  j AS (SELECT page_id, host, path, CASE {_RULE_SQL} END AS rule, lower_bound FROM p JOIN h USING (host))
  SELECT page_id, host, path, rule, CASE WHEN rule IN ({', '.join(f"'{r}'" for v, r in URL_RULES if v == 'allow')}) THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block' WHEN lower_bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict FROM j""")
def url_reputation(spark, sf):
    """Page outcomes are the quality labels of the documents with the page's number; quality 0 counts as bad."""
    labels = table(spark, sf, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    judged = reputation.judge_urls(table(spark, sf, "pages"), outcomes, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


# -- approximate nearest neighbours ----------------------------------------------------------------------------------


@query("op9_permutation_index")
def permutation_index(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return permutation.nearest(vectors, vectors.where("vec_id % 100 = 0"))


# -- language identification -----------------------------------------------------------------------------------------


@query("op2_language_id")
def language_id(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", langid.held_out(F.col("doc_id"), 4, 2))
    model = langid.fit(docs.where("NOT held_out AND doc_id IS NOT NULL"))
    return langid.predict(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score", "rejected")


# -- toxicity --------------------------------------------------------------------------------------------------------


@query("op4_toxicity")
def toxicity_scores(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = langid.held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(docs, table(spark, sf, "labels").where(~out))
    scored = toxicity.score(docs, model)
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return scored.select("doc_id", out.alias("held_out"), "score", predicted.alias("predicted"))


# -- HTML extraction -------------------------------------------------------------------------------------------------


@query("op6_main_text")
def page_text(spark, sf):
    return pagetext.extract(table(spark, sf, "pages").select("page_id", "url", "html"))


# -- substring removal -----------------------------------------------------------------------------------------------


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query("op1_substring_dedup", f"""WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
  windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS s FROM w, unnest(range(1, len(ws) - 18)) r(i)),
  firsts AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS d0, s FROM windows),
  starts AS (SELECT s, d0, min(i) AS i0 FROM firsts WHERE doc_id = d0 GROUP BY s, d0),
  gone AS (SELECT DISTINCT doc_id, j FROM windows JOIN starts USING (s), unnest(range(i, i + 20)) r(j) WHERE doc_id > d0 OR i > i0),
  kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS text FROM
    (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS j, unnest(ws) AS word FROM w) ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
  FROM w LEFT JOIN kept USING (doc_id)""")
def substring_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    kept = substring.remove_repeats(docs)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# -- n-gram Jaccard join ---------------------------------------------------------------------------------------------


@query("op10_partenum_join", f"""WITH RECURSIVE
  w AS (SELECT doc_id, {_WORDS.replace("text", f"translate(text, '{reputation.UPPER}', '{reputation.LOWER}')")} AS ws FROM documents),
  sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM w, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) r(i) WHERE len(ws) > 0),
  n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
  both_in AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
  links AS (SELECT a, b FROM both_in JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
  reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
  SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(min(b), w.doc_id)) AS component_id
  FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach ON a = w.doc_id GROUP BY w.doc_id, n""")
def partenum_join(spark, sf):
    return partenum.similar_components(table(spark, sf, "documents"))


# -- token counts, pieces --------------------------------------------------------------------------------------------


@query("op3_token_count")
def token_count(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return tokencount.count_tokens(docs, vocabulary.load()).drop("text")


@query("op5_pieces")
def piece_round_trip(spark, sf):
    """Encode every text, decode the ids, and report the number of pieces, a digest of them and the decoded text's."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    words = vocabulary.load()
    decoded = pieces.round_trip(docs, words)
    return decoded.select(
        "doc_id", F.size("pieces").cast("long").alias("n_pieces"), F.xxhash64("pieces").alias("pieces_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"),
    )


# -- benchmark decontamination ---------------------------------------------------------------------------------------


@query("op8_decontamination")
def decontamination(spark, sf):
    """One row for each document and benchmark item found in it."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.find_matches(docs, table(spark, sf, "benchmark"))
    hits = found.where(F.size("matches") > 0).select("doc_id", F.explode("matches").alias("m"))
    return hits.select("doc_id", "m.item_id", "m.start", "m.edits")


# -- Merkle manifest -------------------------------------------------------------------------------------------------


def _field_sql(column: str) -> str:
    return f"coalesce(CAST(strlen(CAST({column} AS VARCHAR)) AS VARCHAR) || ':' || CAST({column} AS VARCHAR), '-')"


_LEAF_SQL = " || ".join(map(_field_sql, ["doc_id", "source", "lang", "chars", "text"]))
_CRC_SQL = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
  lambda c, x: list_reduce(list_prepend(xor(c, x), list_transform(range(8), lambda i: CAST(i AS BIGINT))), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))), 4294967295)"""


def _walk_sql(name: str, start: str, nodes: str, same: str) -> str:
    """From a leaf to its tree's root: the digest so far and the siblings passed."""
    return f"""{name} AS ({start} UNION ALL
    SELECT w.doc_id, w.leaf, w.pos0, w.lang, w.lvl + 1, w.pos // 2, (w.n + 1) // 2,
      sha256(CASE WHEN w.pos % 2 = 1 THEN s.h || w.h ELSE w.h || coalesce(s.h, '') END), w.sibs || coalesce(s.h, '')
    FROM {name} w LEFT JOIN {nodes} s ON {same} s.lvl = w.lvl AND s.pos = xor(w.pos, 1) WHERE w.n > 1)"""


@query("op11_merkle", f"""WITH RECURSIVE
  leaves AS (SELECT doc_id, lang, sha256(leaf) AS leaf, sha256(CASE WHEN crc % 7 = 0 THEN changed ELSE leaf END) AS used FROM
    (SELECT doc_id, lang, {_LEAF_SQL.replace('chars', 'n_chars')} AS leaf, {_LEAF_SQL.replace('chars', '(n_chars + 1)')} AS changed, {_CRC_SQL} AS crc FROM documents)),
  placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
  nodes AS (SELECT lang, 0 AS lvl, pos, n, leaf AS h FROM placed UNION ALL
    SELECT lang, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY lang, lvl, pos // 2, n),
  subs AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
  tops AS (SELECT 0 AS lvl, pos, n, h FROM subs UNION ALL
    SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY lvl, pos // 2, n),
  {_walk_sql('low', "SELECT doc_id, leaf, pos AS pos0, lang, 0 AS lvl, pos, n, used AS h, '' AS sibs FROM placed", 'nodes', 's.lang IS NOT DISTINCT FROM w.lang AND')},
  {_walk_sql('high', "SELECT doc_id, leaf, pos0, low.lang, 0 AS lvl, subs.pos, subs.n, low.h, sibs FROM low JOIN subs ON low.lang IS NOT DISTINCT FROM subs.lang WHERE low.n = 1", 'tops', '')}
  SELECT doc_id, leaf, subs.h AS subroot, tops.h AS root, sha256(sibs) AS proof_sha256, high.h AS folded_root, high.h = tops.h AS verified
  FROM high JOIN subs ON high.lang IS NOT DISTINCT FROM subs.lang, tops WHERE high.n = 1 AND tops.n = 1""")
def merkle_manifest(spark, sf):
    """Rows whose id's CRC-32 is divisible by 7 are tampered with: one more character than they have."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    leaf = lambda n: merkle.row_digest([F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text")])
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = F.when(tampered, leaf(F.col("n_chars") + 1))
    leaves = docs.select("doc_id", "lang", leaf(F.col("n_chars")).alias("leaf"), changed.alias("changed"))
    proven = merkle.prove(merkle.build(leaves, "lang", ["doc_id"]), "changed")
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")
    return proven.select(*columns, (F.col("folded_root") == F.col("root")).alias("verified"))


# -- suffix-array removal --------------------------------------------------------------------------------------------


# Bytes as hex text, cut into pieces of 500 window starts, as DuckDB takes parts of short texts faster.
_CUT_END = "CASE WHEN i = 0 THEN 0 ELSE ends[i] END"


@query("op12_run_index", f"""WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
  p AS (SELECT doc_id, length(h) // 2 AS n, b, substring(h, 1000 * b + 1, 1798) AS s FROM d, unnest(range(length(h) // 1000 + 1)) t(b)),
  w AS (SELECT doc_id, 500 * b + j AS i, hash(substring(s, 2 * j + 1, 800)) AS k FROM p, unnest(range(least(500, n - 399 - 500 * b))) r(j)),
  again AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
  hit AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM w SEMI JOIN again USING (k)),
  marked AS (SELECT doc_id, i, sum(CASE WHEN before >= i - 400 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hit),
  runs AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS z FROM marked GROUP BY doc_id, run),
  cuts AS (SELECT doc_id, list(a ORDER BY a) AS starts, list(z ORDER BY a) AS ends FROM runs GROUP BY doc_id)
  SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(list_sum(ends) - list_sum(starts), 0) AS BIGINT) AS n_removed, coalesce(len(starts), 0) AS n_spans,
    sha256(unhex(CASE WHEN starts IS NULL THEN h ELSE array_to_string([substring(h, 2 * {_CUT_END} + 1,
      2 * CASE WHEN i = len(starts) THEN length(h) // 2 ELSE starts[i + 1] END - 2 * {_CUT_END}) FOR i IN range(len(starts) + 1)], '') END)) AS kept_sha256
  FROM d LEFT JOIN cuts USING (doc_id)""")
def run_index(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    kept = runindex.remove_repeats(docs)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# -- fill-in-middle transformation -----------------------------------------------------------------------------------


def _draw_sql(group: int) -> str:
    return f"CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), {8 * group - 7}, 8) AS BIGINT)"


@query("op13_infill", f"""WITH u AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS us FROM documents),
  d AS (SELECT *, len(us) AS n, {_draw_sql(1)} % (len(us) + 1) AS a, {_draw_sql(2)} % (len(us) + 1) AS b, {_draw_sql(3)} % 100 AS c, {_draw_sql(4)} % 100 AS e FROM u),
  p AS (SELECT *, array_to_string(us[1:least(a, b)], '') AS p, array_to_string(us[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(us[greatest(a, b) + 1:], '') AS s,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 100 THEN 'plain' WHEN e < 50 THEN 'spm' ELSE 'psm' END AS form FROM d)
  SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
    sha256(t) AS restored_sha256 FROM p""")
def infill_round_trip(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    formed = infill.fill_in_middle(docs)
    return formed.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


# -- pipeline --------------------------------------------------------------------------------------------------------

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
