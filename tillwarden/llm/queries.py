"""One named query for each operator, over the whole of its table, and the SQL that checks it where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import bpe, decontam, digest, langid, maintext, negatives, passages, phrases, quality, shards, sketch_join, toxicity, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: (host, path, verdict) of the URL filter.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
SHARDS = [f"shard-{i:02d}" for i in range(24)]
VOCABULARY = "byte_bpe_50k.tiktoken"


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def fold_of(parts: int) -> Column:
    """The remainder that splits rows into learned and held-out ones."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


@query
def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(read_table(spark, folder, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def _url_sql() -> str:
    """The same by SQL, with the rounds of propagation written out."""
    rules = ", ".join(f"('{h}{p}', '{h}', '{p}', '{v}')" for h, p, v in RULES)
    host = "CASE WHEN contains({0}, '://') THEN translate(regexp_extract({0}, '://([^/?#]*)', 1), '" + url_filter.UPPER + "', '" + url_filter.LOWER + "') ELSE '' END"
    path = "CASE WHEN contains({0}, '://') THEN regexp_extract({0}, '://[^/?#]*([^?#]*)', 1) ELSE '' END"
    href = url_filter.HREF.replace("'", "''")
    damping = f"{url_filter.DAMPING}e0"
    ctes = [
        f"rules(rule, domain, prefix, said) AS (VALUES {rules})",
        f"split AS (SELECT page_id, html, {host.format('u')} AS host, {path.format('u')} AS path FROM (SELECT *, coalesce(url, '') AS u FROM pages))",
        """judged AS (SELECT page_id, any_value(host) AS host, any_value(path) AS path, arg_max(rule, length(rule)) AS rule, arg_max(said, length(rule)) AS said
        FROM split LEFT JOIN rules ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, prefix) GROUP BY page_id)""",
        f"found AS (SELECT host AS src, unnest(regexp_extract_all(html, '{href}', 1)) AS t FROM split WHERE host <> '')",
        f"""links AS (SELECT src, dst, count(*) AS weight FROM (SELECT src, CASE WHEN NOT contains(t, '://') AND NOT regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:')
        THEN src ELSE {host.format('t')} END AS dst FROM (SELECT src, CASE WHEN starts_with(t, '//') THEN 'http:' || t ELSE t END AS t FROM found)) WHERE dst <> '' GROUP BY 1, 2)""",
        """edges AS (SELECT 'allow' AS kind, src, dst, weight / sum(weight) OVER (PARTITION BY src) AS share FROM links
        UNION ALL SELECT 'block', dst, src, weight / sum(weight) OVER (PARTITION BY dst) FROM links)""",
        "seeds AS (SELECT said AS kind, host, count(*) / sum(count(*)) OVER (PARTITION BY said) AS seed FROM judged WHERE said IS NOT NULL GROUP BY 1, 2)",
        "r0 AS (SELECT kind, host, seed AS score FROM seeds)",
    ]
    for i in range(url_filter.ROUNDS):
        ctes.append(
            f"""r{i + 1} AS (SELECT kind, host, sum(part) AS score FROM (
        SELECT e.kind, e.dst AS host, score * share * {damping} AS part FROM r{i} r JOIN edges e ON r.kind = e.kind AND r.host = e.src
        UNION ALL SELECT kind, host, score * {damping} FROM r{i} r WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.kind = r.kind AND e.src = r.host)
        UNION ALL SELECT kind, host, seed * (1 - {damping}) FROM seeds) GROUP BY 1, 2)"""
        )
    last = f"r{url_filter.ROUNDS}"
    return f"""WITH {", ".join(ctes)} SELECT page_id, j.host, path, rule, coalesce(said, CASE WHEN coalesce(b.score, 0) > 0 AND b.score > coalesce(a.score, 0) * {url_filter.THRESHOLD}e0 * (1 + {url_filter.MARGIN:e}) THEN 'block' ELSE 'allow' END) AS verdict
        FROM judged j LEFT JOIN {last} a ON a.host = j.host AND a.kind = 'allow' LEFT JOIN {last} b ON b.host = j.host AND b.kind = 'block'"""


ORACLES["op1_url_filter"] = _url_sql()


@query
def op2_bucket_digest(spark: SparkSession, folder: str) -> DataFrame:
    return digest.compare_with_next(read_table(spark, folder, "documents"))


def toxic_lexicon(spark: SparkSession, folder: str) -> toxicity.Lexicon:
    return toxicity.learn(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"), fold_of(5) != 0)


@query
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score(read_table(spark, folder, "documents"), toxic_lexicon(spark, folder))
    return scored.select("doc_id", (fold_of(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op4_sketch_join(spark: SparkSession, folder: str) -> DataFrame:
    return sketch_join.join(read_table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    model = quality.learn(docs, read_table(spark, folder, "labels"), fold_of(4) != 2)
    scored = quality.score(docs, model)
    return scored.select("doc_id", (fold_of(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def coded_documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` with the given vocabulary."""
    ranks = bpe.ship_ranks(docs.sparkSession, public_tokenizers.path(VOCABULARY))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)


def code_digests(coded: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return code_digests(coded_documents(read_table(spark, folder, "documents")))


@query
def op7_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.find(read_table(spark, folder, "documents"))


@query
def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shards.place(read_table(spark, folder, "documents"), "doc_id", SHARDS).select("doc_id", "slot", "shard")


@query
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    found = langid.identify(docs, langid.learn(docs, fold_of(3) != 1))
    return found.select("doc_id", (fold_of(3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contained(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def _shingle_sql(table: str, key: str) -> str:
    return f"""SELECT DISTINCT {key}, array_to_string(w[i : i + 4], ' ') AS s FROM (
        SELECT {key}, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM (
        SELECT {key}, list_filter(string_split_regex(lower(text), '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM {table}) WHERE len(w) > 0)"""


ORACLES["op10_decontamination"] = f"""WITH d AS ({_shingle_sql("documents", "doc_id")}), b AS ({_shingle_sql("benchmark", "item_id")}),
    n AS (SELECT item_id, count(*) AS n FROM b GROUP BY 1)
    SELECT doc_id, item_id, c / n AS containment FROM (SELECT doc_id, item_id, count(*) AS c FROM d JOIN b USING (s) GROUP BY 1, 2) JOIN n USING (item_id)
    WHERE c / n >= {decontam.CONTAINED}"""


ORACLES["op4_sketch_join"] = f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(text, '{url_filter.UPPER}', '{url_filter.LOWER}'), '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
    r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, least_id AS component_id FROM documents LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS least_id FROM r GROUP BY 1) USING (doc_id)"""


@query
def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.mine(read_table(spark, folder, "documents"))


ORACLES["op11_phrases"] = f"""WITH w AS (SELECT lang, list_filter(string_split_regex(p, '[ \\t]+'), lambda x: x <> '') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'), '[.,;:!?\\n-\\r]')) AS p FROM documents)),
    c AS (SELECT lang, phrase, k, count(*) AS n FROM (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) v(k) WHERE len(w) >= k)) GROUP BY ALL),
    t AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM c WHERE k = 1 GROUP BY 1),
    keyed AS (SELECT concat(lang, '\t', phrase) AS key, n FROM c WHERE n >= {phrases.LEAST}),
    p AS (SELECT lang, phrase, k, n AS a, string_split(phrase, ' ') AS w FROM c WHERE k > 1 AND n >= {phrases.LEAST}),
    cut AS (SELECT p.lang, p.phrase, a, j, f.n AS l, g.n AS r, CAST((1000000::HUGEINT * a * a) // (f.n::HUGEINT * g.n) AS BIGINT) AS score
        FROM (SELECT *, concat(lang, '\t', array_to_string(w[1 : j], ' ')) AS head, concat(lang, '\t', array_to_string(w[j + 1 :], ' ')) AS rest FROM (SELECT *, unnest(range(1, k)) AS j FROM p)) p
        JOIN keyed f ON f.key = p.head JOIN keyed g ON g.key = p.rest),
    lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    longer AS (SELECT lang, array_to_string(w[i : i + 1], ' ') AS phrase, max(a) AS most FROM (SELECT *, unnest([1, 2]) AS i FROM p WHERE k = 3) GROUP BY 1, 2),
    ranked AS (SELECT o.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
        FROM lowest o LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < {phrases.COVERED} * a)
    SELECT lang, rank, phrase, a, l, r, t.n AS n, score FROM ranked JOIN t USING (lang) WHERE rank <= 2000"""


@query
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read_table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), moved.cast("int").alias("label"), F.col("embedding").alias("vector"))
    return negatives.mine(vectors, F.col("id") % 50 == 0)


ORACLES["op12_hard_negatives"] = f"""WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS anchor_id, e.vec_id AS other, q.label = e.label AS same, CAST(list_sum(list_transform(list_zip(q.v, e.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
        FROM e q JOIN e ON q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0),
    p AS (SELECT anchor_id, other AS positive_id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {negatives.POSITIVES})
    SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, other AS negative_id, p_score AS positive_score, score AS negative_score FROM (
        SELECT s.anchor_id, p.positive_id, s.other, p.score AS p_score, s.score, row_number() OVER (PARTITION BY s.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS rank
        FROM p JOIN s ON s.anchor_id = p.anchor_id WHERE NOT same AND {negatives.LOW} * p.score <= 100 * s.score AND 100 * s.score <= {negatives.HIGH} * p.score)
    WHERE rank <= {negatives.NEGATIVES}"""


@query
def op13_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return maintext.extracted(read_table(spark, folder, "pages"))
