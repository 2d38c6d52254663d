"""The registered queries of the dealt operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sourcetrail.llm.cover_tree import mine
from sourcetrail.llm.decontamination import leaks
from sourcetrail.llm.fp_tree import ranked_documents
from sourcetrail.llm.gru_lm import score_documents
from sourcetrail.llm.html_text import main_text
from sourcetrail.llm.language import identify
from sourcetrail.llm.maxscore import search
from sourcetrail.llm.packing import pack
from sourcetrail.llm.piece_codec import decode, encode
from sourcetrail.llm.redirects import judge
from sourcetrail.llm.repeats import without_repeats
from sourcetrail.llm import toxicity
from sourcetrail.llm.set_join import jaccard_classes
from sourcetrail.llm.tables import crc_mod, table


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose 3-word shingle sets have a similarity of 0.9 or more."""
    return jaccard_classes(table(spark, sf_dir, "documents", "doc_id", "text"), k=3, percent=90)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    import public_tokenizers

    packed = pack(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the strings of 400 bytes that occur again."""
    cut = without_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), min_length=400)
    removed = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"])
    return cut.select(
        "doc_id",
        (F.octet_length("kept_bytes") + removed).alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("removed_spans").cast("long").alias("n_spans"),
        F.sha2("kept_bytes", 256).alias("kept_sha256"),
    )


#: Rows that are kept from fitting, by their id.
TOXICITY_FOLDS, TOXICITY_HELD_OUT, TOXIC_FROM = 4, 2, 0.3


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Fitted on the given documents and labels without the held-out rows."""
    learn = crc_mod("doc_id", TOXICITY_FOLDS) != TOXICITY_HELD_OUT
    docs = table(spark, sf_dir, "documents", "doc_id", "text").where(learn)
    return toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic").where(learn))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    scored = toxicity.with_scores(table(spark, sf_dir, "documents", "doc_id", "text"), toxicity_model(spark, sf_dir))
    return scored.select(
        "doc_id",
        F.coalesce(crc_mod("doc_id", TOXICITY_FOLDS) == TOXICITY_HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items in each document that holds some; documents without one have no row."""
    found = leaks(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "doc_start", "item_start", "length", "agree")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector with all others, in 1/1024 steps."""
    given = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    given = given.where(F.col("embedding").isNotNull() & finite)
    steps = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1024))
    vectors = given.select("vec_id", steps.alias("components"))
    return search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page, learned from the documents' languages."""
    return identify(table(spark, sf_dir, "pages", "page_id", "url", "html"), table(spark, sf_dir, "documents", "text", "lang"))


#: Of so many parts of the documents one is kept from training the language model.
LM_FOLDS = 10


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under the language model and under smoothed word shares."""
    held_out = F.coalesce(crc_mod("doc_id", LM_FOLDS) == 0, F.lit(False))
    return score_documents(table(spark, sf_dir, "documents", "doc_id", "text"), held_out)


#: (verdict, host with its subdomains, beginning of the path)
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return judge(table(spark, sf_dir, "pages", "page_id", "url", "html"), URL_RULES)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded into pieces and decoded again, as digests."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    back = decode(encode(table(spark, sf_dir, "documents", "doc_id", "text"), model), model)
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector for each of its five positives, in 1/256 steps."""
    given = table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    steps = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    vectors = given.where(F.col("embedding").isNotNull() & finite).select("vec_id", label.alias("label"), steps.alias("components"))
    return mine(vectors, lambda vec_id: vec_id % 100 == 0)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked_documents(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op2_exact_topk": op2_exact_topk,
    "op7_lm_scoring": op7_lm_scoring,
    "op3_language_id": op3_language_id,
    "op8_url_filters": op8_url_filters,
    "op9_html_extraction": op9_html_extraction,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op5_toxicity": op5_toxicity,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_ranked_search": op12_ranked_search,
    "op13_sentencepiece": op13_sentencepiece,
}

#: The given pages declare neither canonical links nor refreshes (a test holds them to that), so rules and default decide.
_OP8_SQL = r"""
WITH split AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
    FROM split
), rules(verdict, host, path) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
        ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
    SELECT p.page_id, max_by(struct_pack(rule := r.host || r.path, verdict := r.verdict), length(r.host || r.path)) AS best
    FROM parts p JOIN rules r
        ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    GROUP BY p.page_id
)
SELECT p.page_id, p.host, p.path, f.best.rule AS rule, coalesce(f.best.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id
"""
_OP2_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS c FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), p AS (
    SELECT q.vec_id AS query_id, v.vec_id, CAST(list_sum(list_transform(list_zip(q.c, v.c), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0
), r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
_OP11_SQL = """
WITH v AS (
    SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS c
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), p AS (
    SELECT a.row AS anchor, a.vec_id AS anchor_id, v.row, v.vec_id, v.label = a.label AS same,
        coalesce(CAST(list_sum(list_transform(list_zip(a.c, v.c), lambda z: z[1] * z[2])) AS BIGINT), 0) AS score
    FROM v a JOIN v ON a.row <> v.row WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor, anchor_id, row AS positive, vec_id AS positive_id, score AS positive_score FROM p WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row) <= 5
), negatives AS (
    SELECT s.anchor_id, s.positive_id, CAST(row_number() OVER (PARTITION BY s.anchor, s.positive ORDER BY p.score DESC, p.vec_id, p.row) AS INTEGER) AS rank,
        p.vec_id AS negative_id, s.positive_score, p.score AS negative_score
    FROM positives s JOIN p ON p.anchor = s.anchor AND NOT p.same
    WHERE 30 * s.positive_score <= 100 * p.score AND 100 * p.score <= 90 * s.positive_score
)
SELECT * FROM negatives WHERE rank <= 10
"""
_OP12_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents WHERE text IS NOT NULL
), i AS (
    SELECT row_number() OVER () AS item, item_id, list_distinct(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
    FROM benchmark WHERE text IS NOT NULL
), n AS (SELECT row, doc_id, len(words) AS n FROM d WHERE len(words) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM n),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(words) AS term FROM d) GROUP BY row, term),
w AS (
    SELECT term, CAST(floor(1000 * ln((2 * s.docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s
), m AS (SELECT row, doc_id, 10 + (90 * n * s.docs) // s.total AS m FROM n, s),
q AS (SELECT item, item_id, unnest(terms) AS term FROM i),
p AS (
    SELECT q.item, q.item_id, m.row, m.doc_id, CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m))) AS BIGINT) AS score
    FROM q JOIN w ON w.term = q.term JOIN tf ON tf.term = q.term JOIN m ON m.row = tf.row
    GROUP BY q.item, q.item_id, m.row, m.doc_id
), r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM p WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
LLM_ORACLES: dict[str, str] = {"op2_exact_topk": _OP2_SQL, "op8_url_filters": _OP8_SQL, "op11_hard_negatives": _OP11_SQL, "op12_ranked_search": _OP12_SQL}
