"""The registered queries of this folder: thin wrappers that read the tables and give the agreed columns."""

from pyspark.sql import functions as F

from corpusmill.llm import (
    anchors,
    bagminhash,
    cells,
    decontaminate,
    dialogues,
    mixing,
    packing,
    rules,
    secrets,
    sharding,
    suffixes,
    toxicity,
    whitening,
)
from corpusmill.session import table

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op3_curriculum_mix")
def op3(spark, folder):
    return mixing.curriculum(table(spark, folder, "documents"))


@query("op6_slot_shards")
def op6(spark, folder):
    return sharding.shard(table(spark, folder, "documents"))


@query("op7_linked_secrets")
def op7(spark, folder):
    found = secrets.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *[f"n_{k}" for k in secrets.KINDS],
        F.sha2(secrets.digest(F.col("base")), 256).alias("base_sha256"),
        secrets.digest(F.col("all")).alias("spans"),
    )


@query("op4_bagminhash")
def op4(spark, folder):
    found = bagminhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "n_copies", "component_id", "kept")


@query("op1_rule_quality")
def op1(spark, folder):
    return rules.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op2_gru_toxicity")
def op2(spark, folder):
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op10_vector_cells")
def op10(spark, folder):
    return cells.near_duplicates(table(spark, folder, "embeddings"))


@query("op9_spaced_seeds")
def op9(spark, folder):
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query(
    "op5_cover_anchors",
    """
    WITH words AS (
        SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
        FROM documents
    ), windows AS (
        SELECT doc_id, i, w[i:i + 12] AS seq FROM words, range(1, len(w) - 11) AS r(i) WHERE len(w) >= 13
    ), firsts AS (
        SELECT seq, min(doc_id) AS first FROM windows GROUP BY seq
    ), gone AS (
        SELECT DISTINCT doc_id, i + d AS k FROM windows JOIN firsts USING (seq), range(0, 13) AS s(d) WHERE first < doc_id
    ), lists AS (
        SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id
    )
    SELECT doc_id, len(w) AS n_words, len(coalesce(ks, [])) AS n_removed,
           sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(ks, []), i)), ' ')) AS kept_sha256
    FROM words LEFT JOIN lists USING (doc_id)
    """,
)
def op5(spark, folder):
    found = anchors.without_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_sparse_suffixes")
def op8(spark, folder):
    found = suffixes.without_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_viterbi_repair")
def op11(spark, folder):
    return dialogues.repair(table(spark, folder, "conversations"), damage=True)


@query("op12_cholesky_whitening")
def op12(spark, folder):
    found = whitening.whiten(table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


@query("op13_bin_completion")
def op13(spark, folder):
    import public_tokenizers

    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
