"""Registered queries for rows that plain inputs do not have: NULL keys and cells, files that
differ in layout or change, several processes, nested input. Importing this adds them to the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusprep.functions.tokens import ids_text
from corpusprep.plans import derived
from corpusprep.plans.catalog import (A_SQL, Q_SQL, SQL_BATCHES, SQL_EVALS, SQL_EXCHANGES, SQL_SHUFFLE_KEY, SQL_SPLIT_DOCS, _batches, _chat_out,
                                      _evals, _pairs, _scratch, _split_only, register, sql_chat, table)

SQL_NULL_PAIRS = SQL_EXCHANGES.strip() + f""",
cells AS (SELECT conv_id, turn, {Q_SQL} || CASE WHEN conv_id % 11 <> 0 THEN prompt END || {A_SQL} AS prompt,
                 CASE WHEN turn % 5 <> 0 THEN chosen END AS chosen, CASE WHEN conv_id % 7 <> 0 THEN rejected END AS rejected FROM pairs)"""


@register("row_index_null_groups", """
SELECT doc_id, CAST(row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS BIGINT) AS row_idx
FROM (SELECT doc_id, CASE WHEN lang <> 'de' THEN lang END AS g FROM documents) AS t""")
def q_row_index_null_groups(spark, sf_dir):
    """Row index per language, with a NULL group: its rows are numbered like any other group's."""
    from corpusprep.operators.ordering import row_index
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang") != "de", F.col("lang")).alias("g"))
    return row_index(docs, ["doc_id"], partition_by="g").select("doc_id", "row_idx")


@register("grouped_scan_null_groups", """
SELECT doc_id, CAST(sum(n_chars) OVER (PARTITION BY g ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS chars
FROM (SELECT doc_id, n_chars, CASE WHEN lang <> 'de' THEN lang END AS g FROM documents) AS t""")
def q_grouped_scan_null_groups(spark, sf_dir):
    """Running character count per language, with a NULL group."""
    from corpusprep.operators.ordering import grouped_scan
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.when(F.col("lang") != "de", F.col("lang")).alias("g"))
    return grouped_scan(docs, ["g"], "doc_id", {"chars": ("sum", "n_chars")}).select("doc_id", F.col("chars").cast("bigint"))


@register("pair_quarantine", f"""
WITH {SQL_NULL_PAIRS}
SELECT conv_id, turn, prompt, chosen, rejected,
       CASE WHEN prompt IS NULL THEN 'prompt is NULL' WHEN chosen IS NULL THEN 'chosen is NULL' WHEN rejected IS NULL THEN 'rejected is NULL'
            WHEN length(prompt) + length(chosen) > 1024 OR length(prompt) + length(rejected) > 1024 THEN 'pair too long' END AS reason
FROM cells""")
def q_pair_quarantine(spark, sf_dir):
    """Pairs with NULL cells: the kept pairs and the quarantined ones with their reason are all rows."""
    from corpusprep.plans.preference import prepare_pairs, quarantined_pairs
    pairs = _pairs(spark, sf_dir).withColumns({
        "prompt": F.when(F.col("conv_id") % 11 != 0, F.col("prompt")), "chosen": F.when(F.col("turn") % 5 != 0, F.col("chosen")),
        "rejected": F.when(F.col("conv_id") % 7 != 0, F.col("rejected"))})
    kept = prepare_pairs(pairs, max_length=1024, keep=("conv_id", "turn")).withColumn("reason", F.lit(None).cast("string"))
    return kept.unionByName(quarantined_pairs(pairs, max_length=1024, keep=("conv_id", "turn"))).drop("split")


@register("final_best", f"""
WITH {SQL_EVALS.strip()},
e AS (SELECT run, completed_steps, eval_loss FROM evals WHERE completed_steps % 7 <> 0)
SELECT run, eval_loss AS best_loss, completed_steps AS best_step
FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY eval_loss, completed_steps) AS rn FROM e) AS r WHERE rn = 1""")
def q_final_best(spark, sf_dir):
    """Best evaluation per run; some losses are missing, and a missing loss is never best."""
    from corpusprep.operators.runlog import final_best
    evals = _evals(spark, sf_dir).withColumn("eval_loss", F.when(F.col("completed_steps") % 7 != 0, F.col("eval_loss")))
    return final_best(evals)


@register("epoch_plan_processes", f"""
WITH {SQL_SPLIT_DOCS.strip()},
n AS (SELECT split, count(*) AS n_examples FROM split_docs GROUP BY split),
b AS (SELECT *, CAST(ceil(n_examples / 8.0) AS BIGINT) AS batches FROM n),
u AS (SELECT *, CAST(ceil(ceil(batches / 4.0) / 2.0) AS BIGINT) AS updates_per_epoch FROM b)
SELECT split, CAST(n_examples AS BIGINT) AS n_examples, batches, updates_per_epoch,
       CAST(updates_per_epoch * 3 AS BIGINT) AS total_updates, CAST(3 AS BIGINT) AS epochs, CAST(64 AS BIGINT) AS total_batch_size
FROM u""")
def q_epoch_plan_processes(spark, sf_dir):
    """Batch size 8, accumulation 2, 3 epochs, four processes that share the batches."""
    from corpusprep.operators.batching import epoch_plan
    return epoch_plan(_split_only(spark, sf_dir), 8, accumulation=2, epochs=3, processes=4)


@register("collate_label_ids", f"""
WITH {SQL_BATCHES.strip()},
x AS (SELECT batch_no, pos, CASE WHEN l.doc_id IS NOT NULL THEN quality || ',' || toxic END AS ids
      FROM bt LEFT JOIN labels l USING (doc_id))
SELECT CAST(batch_no AS BIGINT) AS batch_no, CAST(pos AS BIGINT) AS pos,
       CASE WHEN first_value(ids) OVER (PARTITION BY batch_no ORDER BY pos) IS NOT NULL THEN ids END AS labels
FROM x""")
def q_collate_label_ids(spark, sf_dir):
    """Batches of 8 whose labels come from ``label_ids``, judged on the batch's first row."""
    from corpusprep.operators.batching import collate
    lab = table(spark, sf_dir, "labels").select("doc_id", F.array("quality", "toxic").alias("label_ids"))
    rows = _batches(spark, sf_dir).select("doc_id", "batch_no", "pos").join(lab, "doc_id", "left").drop("doc_id")
    return collate(rows).select("batch_no", "pos", ids_text("labels").alias("labels"))


@register("seeded_shuffle_train", f"""
WITH {SQL_SPLIT_DOCS.strip()}
SELECT doc_id, CAST(row_number() OVER (ORDER BY {SQL_SHUFFLE_KEY.format(seed=42, col='doc_id')}, doc_id) - 1 AS BIGINT) AS shuffle_idx
FROM split_docs WHERE split = 'train'""")
def q_seeded_shuffle_train(spark, sf_dir):
    """The permutation of the whole train split with seed 42."""
    from corpusprep.operators.ordering import seeded_shuffle
    train = _split_only(spark, sf_dir).where("split = 'train'").select("doc_id")
    return seeded_shuffle(train, 42, "doc_id").select("doc_id", "shuffle_idx")


@register("chat_nested", sql_chat(2048, 2048))
def q_chat_nested(spark, sf_dir):
    """Conversations as nested JSON rows (``conversations: [{from, value}]``), written and read back: ids, labels and mask."""
    from corpusprep.operators.chat import chat_examples_nested
    from corpusprep.sources.files import CONVERSATION_SCHEMA
    from pyspark.sql import types as T
    from corpusprep.operators.ordering import grouped_scan
    path = _scratch(spark, "chats-json")
    messages = derived.chat_messages(table(spark, sf_dir, "conversations")).withColumn("n", F.length("value") + 1)
    # messages past the limits add nothing and are dropped before a conversation is gathered, which so stays bounded
    messages = grouped_scan(messages, ["conv_id"], "turn", {"before": ("sum", "n")}, inclusive=False).where("before < 2048")
    turns = F.transform(F.sort_array(F.collect_list(F.struct("turn", F.col("from"), F.col("value")))),
                        lambda m: F.struct(m["from"].alias("from"), m["value"].alias("value")))
    messages.groupBy("conv_id").agg(turns.alias("conversations")).write.json(path)
    schema = T.StructType([T.StructField("conv_id", T.LongType()), *CONVERSATION_SCHEMA.fields])
    nested = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return _chat_out(chat_examples_nested(nested, max_source=2048, max_target=2048, keep=("conv_id",)))


@register("csv_header_order", f"""
WITH {SQL_EXCHANGES.strip()}
SELECT prompt, chosen, rejected FROM pairs""")
def q_csv_header_order(spark, sf_dir):
    """Preference CSV files whose headers name the columns in different orders."""
    from corpusprep.sources.files import read_pairs_csv
    path = _scratch(spark, "pairs-csv-order")
    for part, columns in enumerate((["prompt", "chosen", "rejected"], ["rejected", "chosen", "prompt"])):
        _pairs(spark, sf_dir).where(F.col("conv_id") % 2 == part).select(*columns).write.mode("append") \
            .option("header", "true").option("escape", '"').option("quoteAll", "true").csv(path)
    return read_pairs_csv(spark, path)


@register("file_types", """
SELECT CASE WHEN doc_id % 3 < 2 THEN 'train' ELSE 'validation' END AS split, CASE WHEN doc_id % 3 = 1 THEN 'txt' ELSE 'json' END AS extension,
       CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars, doc_id % 3 < 2 AS refused
FROM documents GROUP BY ALL""")
def q_file_types(spark, sf_dir):
    """Rows and characters per split and extension of a corpus whose train split mixes two file types, which is refused."""
    from corpusprep.sources.files import check_one_type, discover_files
    base = _scratch(spark, "mixed")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    line = F.to_json(F.struct("doc_id", "text")).alias("value")
    docs.where("doc_id % 3 = 0").write.json(f"{base}/train/a")
    docs.where("doc_id % 3 = 1").select(line).write.text(f"{base}/train/b")
    docs.where("doc_id % 3 = 2").write.json(f"{base}/validation/a")
    found = check_one_type({s: discover_files(spark, f"{base}/{s}") for s in ("train", "validation")}, raise_error=False)
    out = None
    for split, extensions in found.items():
        lines = spark.read.option("recursiveFileLookup", "true").text(f"{base}/{split}")
        d = lines.select(F.lit(split).alias("split"), F.regexp_extract("_metadata.file_path", r"\.([^./]+)$", 1).alias("extension"),
                         F.length(F.get_json_object("value", "$.text")).alias("n"))
        d = d.groupBy("split", "extension").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").cast("bigint").alias("n_chars"))
        d = d.withColumn("refused", F.lit(len(extensions) > 1))
        out = d if out is None else out.unionByName(d)
    return out


@register("reuse_after_change", f"""
WITH {SQL_SPLIT_DOCS.strip()}
SELECT split, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars, true AS first_reused, false AS second_reused
FROM split_docs GROUP BY split""")
def q_reuse_after_change(spark, sf_dir):
    """A prepared table is reused while its input files stay as they are, and made anew, as a new version, once their content changes."""
    from corpusprep.sources.sinks import read_prepared, write_prepared
    base = _scratch(spark, "changing")
    docs = _split_only(spark, sf_dir).select("split", "doc_id", F.length("text").alias("n"))

    def prepared():
        return write_prepared(spark.read.parquet(f"{base}/in"), f"{base}/out", params={"v": 1}, input_files=[f"{base}/in"])

    docs.where("doc_id % 2 = 0").write.parquet(f"{base}/in")
    prepared()
    _, first = prepared()
    docs.write.mode("overwrite").parquet(f"{base}/in")
    _, second = prepared()
    out = read_prepared(spark, f"{base}/out").groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").cast("bigint").alias("n_chars"))
    return out.withColumns({"first_reused": F.lit(first), "second_reused": F.lit(second)})
