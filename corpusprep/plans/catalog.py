"""Registered queries over the driver tables, each with its DuckDB oracle SQL.

Every query reads the given parquet tables (or tables Spark derives from them) in full.
Arrays are returned as comma-joined text so that results compare by value. The SQL forms are
deliberately brute force (whole token streams, plain windows over whole groups): they are an
independent check of the distributed plans, not a model of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.constants import ANSWER_TEXT, EOS_TEXT, QUESTION_TEXT, TEMPLATES
from corpusprep.functions.tokens import codepoint_ids, decode_ids, ids_text, labels_for_display
from corpusprep.plans import derived

TEMPLATE_NAME, _SYSTEM, TEMPLATE_TEXT, _ROLES, TEMPLATE_SEP = TEMPLATES[0]
Q_SQL, A_SQL = f"'{QUESTION_TEXT}'", f"'{ANSWER_TEXT}'"  # marker texts as SQL literals

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------------------------------------------
# SQL building blocks
# ------------------------------------------------------------------------------------------------

def sql_ids(text: str) -> str:
    return (f"(CASE WHEN length({text}) = 0 THEN []::INTEGER[] "
            f"ELSE list_transform(string_split({text}, ''), lambda c: unicode(c) + 256) END)")


def sql_repeat(value: int, n: str) -> str:
    return f"list_transform(range(greatest({n}, 0)), lambda x: {value})"


NL2 = "chr(10) || chr(10)"
SQL_SHUFFLE_KEY = "('0x' || substr(md5('{seed}-' || CAST({col} AS VARCHAR)), 1, 15))::BIGINT"

SQL_SPLIT_DOCS = """
split_docs AS (
  SELECT doc_id, text, source, lang,
         CASE WHEN gidx < cut THEN 'validation' ELSE 'train' END AS split,
         CASE WHEN gidx < cut THEN gidx ELSE gidx - cut END AS row_idx
  FROM (SELECT doc_id, text, source, lang, row_number() OVER (ORDER BY doc_id) - 1 AS gidx,
               CAST(round_even(count(*) OVER () * 5 / 100.0, 0) AS BIGINT) AS cut
        FROM documents) AS ranked
)"""

SQL_EXCHANGES = """
ex AS (SELECT u.conv_id, u.turn, u.text AS usr, a.text AS answer
       FROM conversations u JOIN conversations a
         ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
       WHERE u.role = 'user'),
sys AS (SELECT conv_id, arg_min(text, turn) AS system FROM conversations WHERE role = 'system' GROUP BY conv_id),
triples AS (SELECT ex.conv_id, ex.turn, usr AS instruction, sys.system AS input, answer AS output
            FROM ex LEFT JOIN sys USING (conv_id)),
pairs AS (SELECT e.conv_id, e.turn, e.usr AS prompt, e.answer AS chosen, n.answer AS rejected
          FROM ex e JOIN ex n ON n.conv_id = e.conv_id + 1 AND n.turn = e.turn)"""

SQL_SOURCE = ("CASE WHEN input IS NOT NULL AND input <> '' THEN instruction || chr(10) || input "
              "ELSE instruction END")

SQL_TRAIN_LOG = f"""
tl0 AS (SELECT user_id AS run, value / 100.0 AS loss,
               row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), event_id) - 1 AS micro_step
        FROM events),
train_log AS (SELECT run, CAST(micro_step // {derived.STEPS_PER_EPOCH} AS INTEGER) AS epoch, micro_step, loss,
                     ((micro_step % {derived.STEPS_PER_EPOCH}) + 1) % {derived.ACCUMULATION} = 0
                     OR micro_step % {derived.STEPS_PER_EPOCH} = {derived.STEPS_PER_EPOCH - 1} AS sync
              FROM tl0),
cs AS (SELECT *, sum(CAST(sync AS BIGINT)) OVER (PARTITION BY run ORDER BY micro_step
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS completed_steps FROM train_log)"""

SQL_EVALS = f"""
t0 AS (SELECT min(epoch_us(ts)) AS t0 FROM events),
eval_log AS (SELECT user_id AS run,
                    CAST(floor((epoch_us(ts) - t0) / {derived.EVAL_EPOCH_DAYS * 86400 * 10**6}) AS INTEGER) AS epoch,
                    CAST(floor((epoch_us(ts) - t0) / 3600000000) + 1 AS BIGINT) AS completed_steps,
                    event_id AS batch_no, CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS n,
                    value / 100.0 AS loss
             FROM events JOIN t0 ON true),
evals AS (SELECT run, epoch, completed_steps, CAST(sum(n) AS BIGINT) AS n_examples,
                 CAST(sum(CAST(loss AS DECIMAL(18,4)) * n) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS eval_loss
          FROM eval_log GROUP BY run, epoch, completed_steps)"""


def sql_pack(block: int, rows_per_batch: int, keep_short: bool = True, split_docs: str = SQL_SPLIT_DOCS,
             with_split: bool = True, src: str = "split_docs") -> str:
    """Brute force: every token gets its position in the batch stream; tokens below the kept
    length are grouped by position // block."""
    short = "total" if keep_short else "0"
    split_out = "split, " if with_split else ""
    return f"""
WITH {split_docs.strip()},
toks AS (SELECT split, row_idx, row_idx // {rows_per_batch} AS batch_id, {sql_ids('text')} AS ids FROM {src}),
starts AS (SELECT split, batch_id, ids,
                  coalesce(sum(len(ids)) OVER (PARTITION BY split, batch_id ORDER BY row_idx
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
                  sum(len(ids)) OVER (PARTITION BY split, batch_id) AS total
           FROM toks),
flat AS (SELECT split, batch_id, total, start + unnest(range(len(ids))) AS pos, unnest(ids) AS tok FROM starts),
kept AS (SELECT *, CASE WHEN total >= {block} THEN (total // {block}) * {block} ELSE {short} END AS keep FROM flat)
SELECT {split_out}CAST(batch_id AS BIGINT) AS batch_id, CAST(pos // {block} AS BIGINT) AS block_no,
       CAST(count(*) AS BIGINT) AS n_tokens, array_to_string(list(tok ORDER BY pos), ',') AS ids,
       true AS labels_same
FROM kept WHERE pos < keep
GROUP BY split, batch_id, pos // {block}
"""


def _blocks_out(blocks: DataFrame) -> DataFrame:
    return blocks.select(
        "split", F.col("batch_id").cast("bigint").alias("batch_id"),
        F.col("block_no").cast("bigint").alias("block_no"),
        F.size("input_ids").cast("bigint").alias("n_tokens"),
        ids_text("input_ids").alias("ids"),
        (F.col("labels") == F.col("input_ids")).alias("labels_same"))


def _split_docs(spark, sf_dir) -> DataFrame:
    """Documents with ``split`` and ``row_idx`` (position inside the split)."""
    from corpusprep.operators.ordering import head_percent_split
    docs = table(spark, sf_dir, "documents")
    return head_percent_split(docs.select("doc_id", "text", "source", "lang"), ["doc_id"], 5)


def _split_only(spark, sf_dir) -> DataFrame:
    """Documents with ``split`` only: the rows are not shuffled (boundary key + comparison)."""
    from corpusprep.operators.ordering import head_percent_split
    docs = table(spark, sf_dir, "documents")
    return head_percent_split(docs.select("doc_id", "text", "source", "lang"), ["doc_id"], 5, keep_index=False)


# ------------------------------------------------------------------------------------------------
# packing and order
# ------------------------------------------------------------------------------------------------

@register("pack_blocks", sql_pack(1024, 1000))
def q_pack_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: documents -> 5% head validation split -> codepoint tokens -> blocks of 1024
    per batch of 1000 rows -> labels."""
    from corpusprep.plans.pretrain import pretrain_blocks
    docs = table(spark, sf_dir, "documents")
    return _blocks_out(pretrain_blocks(docs, ["doc_id"], block_size=1024, rows_per_batch=1000))


@register("pack_blocks_one_shuffle", sql_pack(1024, 1000))
def q_pack_blocks_one_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship with the plan chosen for large inputs: order, split and packing fused so
    the text crosses the network once and is read once (``pack_corpus_text`` with the stored
    ``n_chars``)."""
    from corpusprep.plans.pretrain import pretrain_blocks
    from corpusprep.operators.packing import pack_corpus_text
    docs = table(spark, sf_dir, "documents")
    # the stored character count (n_chars) lets the pre-pass skip the text; checked per row
    return _blocks_out(pack_corpus_text(docs, "doc_id", 1024, 1000, percent=5, length_col="n_chars"))


def sql_pack_scope(block: int, where: str = "true") -> str:
    """Brute force: the whole split concatenated and cut."""
    return f"""
SELECT split, block_no, n_tokens, ids, labels_same FROM ({sql_pack(block, 10 ** 15)}) AS p WHERE {where}"""


def _scope_out(blocks: DataFrame) -> DataFrame:
    return blocks.select("split", F.col("block_no").cast("bigint").alias("block_no"), F.size("input_ids").cast("bigint").alias("n_tokens"),
                         ids_text("input_ids").alias("ids"), (F.col("labels") == F.col("input_ids")).alias("labels_same"))


@register("pack_corpus_scope", sql_pack_scope(1024))
def q_pack_corpus_scope(spark, sf_dir):
    """Each split is one token stream: no row batches. The block size comes from the tokenizer's limit."""
    from corpusprep.plans.pretrain import pretrain_blocks
    docs = table(spark, sf_dir, "documents")
    return _scope_out(pretrain_blocks(docs, ["doc_id"], block_size=None, model_max_length=1024, scope="corpus"))


@register("pack_corpus_scope_by_text", sql_pack_scope(2048, "split = 'train' AND block_no < 300 OR split = 'validation' AND block_no < 15")
          .replace("ORDER BY doc_id", "ORDER BY source, lang, doc_id"))
def q_pack_corpus_scope_by_text(spark, sf_dir):
    """The same on a tokenized table, ordered and split by strings (source, language, id), with sample limits in blocks."""
    from corpusprep.operators.ordering import head_limit, head_percent_split
    from corpusprep.operators.packing import pack_whole_splits
    from corpusprep.operators.tokenizing import tokenize
    order = ["source", "lang", "doc_id"]
    docs = head_percent_split(table(spark, sf_dir, "documents").select("text", *order), order, 5, keep_index=False)
    blocks = pack_whole_splits(tokenize(docs), order, 2048, text_col=None)
    return _scope_out(head_limit(blocks, {"train": 300, "validation": 15}, index_col="block_no"))


@register("row_index_by_text", """
SELECT doc_id, source, CAST(row_number() OVER (ORDER BY lang, source, text, doc_id) - 1 AS BIGINT) AS row_idx,
       CAST(row_number() OVER (PARTITION BY lang ORDER BY text, doc_id) - 1 AS BIGINT) AS in_lang,
       CAST(coalesce(sum(n_chars) OVER (PARTITION BY lang ORDER BY text, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS chars_before
FROM documents""")
def q_row_index_by_text(spark, sf_dir):
    """Positions by string keys whose first columns are held by many rows, and by text within a language."""
    from corpusprep.operators.ordering import row_index
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text", "n_chars")
    docs = row_index(docs, ["lang", "source", "text", "doc_id"])
    docs = row_index(docs, ["text", "doc_id"], partition_by="lang", name="in_lang", prefix_sums={"chars_before": F.col("n_chars")})
    return docs.select("doc_id", "source", "row_idx", "in_lang", F.col("chars_before").cast("bigint").alias("chars_before"))


@register("pack_stored_tokens", sql_pack(1024, 1000))
def q_pack_stored_tokens(spark, sf_dir):
    """A tokenized corpus stored as parquet (doc_id, input_ids, attention_mask), packed with
    the arrays shuffled once (``pack_corpus_ids``)."""
    from corpusprep.operators.packing import pack_corpus_ids
    from corpusprep.operators.tokenizing import store_tokens
    stored = store_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), _scratch(spark, "stored-tokens"))
    blocks = pack_corpus_ids(stored, "doc_id", 1024, 1000, percent=5, length_col="n_tokens")  # pre-pass reads counts only
    return _blocks_out(blocks)


@register("pack_short_tail", sql_pack(2048, 1))
def q_pack_short_tail(spark, sf_dir):
    """Array packing (the model-tokenizer path) with one row per batch: short documents make
    one short block, long ones lose their tail."""
    from corpusprep.operators.packing import pack_blocks
    from corpusprep.operators.tokenizing import tokenize
    toks = tokenize(_split_docs(spark, sf_dir).select("split", "row_idx", "text"))
    return _blocks_out(pack_blocks(toks, 2048, 1))


@register("packing_report", f"""
WITH {SQL_SPLIT_DOCS.strip()},
pb AS (SELECT split, row_idx // 100 AS batch_id, count(*) AS nrows, sum(length(text)) AS tokens
       FROM split_docs GROUP BY split, row_idx // 100),
k AS (SELECT *, CASE WHEN tokens >= 1024 THEN (tokens // 1024) * 1024 ELSE tokens END AS kept,
             CASE WHEN tokens >= 1024 THEN tokens // 1024 WHEN tokens > 0 THEN 1 ELSE 0 END AS blocks,
             CASE WHEN tokens > 0 AND tokens < 1024 THEN 1 ELSE 0 END AS short FROM pb)
SELECT split, CAST(sum(nrows) AS BIGINT) AS rows_in, CAST(sum(tokens) AS BIGINT) AS tokens_in,
       CAST(count(*) AS BIGINT) AS batches, CAST(sum(blocks) AS BIGINT) AS blocks,
       CAST(sum(kept) AS BIGINT) AS tokens_kept, CAST(sum(tokens) - sum(kept) AS BIGINT) AS tokens_dropped,
       CAST(sum(short) AS BIGINT) AS short_blocks
FROM k GROUP BY split""")
def q_packing_report(spark, sf_dir):
    """Per split: what packing keeps and drops. Only (doc_id, length) is indexed: no text moves."""
    from corpusprep.operators.ordering import head_percent_split
    from corpusprep.operators.packing import packing_report
    from corpusprep.functions.tokens import token_count
    docs = table(spark, sf_dir, "documents").select("doc_id", token_count("text").alias("n"))
    rows = head_percent_split(docs, ["doc_id"], 5)
    return packing_report(rows, 1024, 100, length=F.col("n"))


@register("pack_limited", f"""
SELECT split, batch_id, block_no, n_tokens, ids, block_idx FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY split ORDER BY batch_id, block_no) - 1 AS BIGINT) AS block_idx
  FROM ({sql_pack(1024, 100)}) AS p) AS q
WHERE (split = 'train' AND block_idx < 500) OR (split = 'validation' AND block_idx < 20)""")
def q_pack_limited(spark, sf_dir):
    """Sample limits count packed blocks (train 500, validation 20)."""
    from corpusprep.plans.pretrain import pretrain_blocks
    b = pretrain_blocks(table(spark, sf_dir, "documents"), ["doc_id"], block_size=1024, rows_per_batch=100,
                        max_train_samples=500, max_eval_samples=20)
    return b.select("split", "batch_id", "block_no", F.size("input_ids").cast("bigint").alias("n_tokens"), ids_text("input_ids").alias("ids"), "block_idx")


@register("split_counts", f"""
WITH {SQL_SPLIT_DOCS.strip()}
SELECT split, CAST(count(*) AS BIGINT) AS n_rows FROM split_docs GROUP BY split""")
def q_split_counts(spark, sf_dir):
    """Rows per split after the 5 % head validation cut (membership only, rows not shuffled)."""
    from corpusprep.operators.ordering import split_counts
    return split_counts(_split_only(spark, sf_dir))


@register("head_limit", f"""
WITH {SQL_SPLIT_DOCS.strip()}
SELECT split, row_idx, doc_id FROM split_docs
WHERE (split = 'train' AND row_idx < 100) OR (split = 'validation' AND row_idx < 10)""")
def q_head_limit(spark, sf_dir):
    """First 100 train / 10 validation rows: membership split, then a top-k per split."""
    from corpusprep.plans.sft import split_and_limit
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return split_and_limit(docs, ["doc_id"], percent=5, max_train_samples=100, max_eval_samples=10) \
        .select("split", "row_idx", "doc_id")


@register("seeded_shuffle_head", f"""
WITH {SQL_SPLIT_DOCS.strip()},
lim AS (SELECT doc_id FROM split_docs WHERE split = 'train' AND row_idx < 200)
SELECT doc_id, CAST(row_number() OVER (ORDER BY {SQL_SHUFFLE_KEY.format(seed=42, col='doc_id')}, doc_id) - 1 AS BIGINT)
       AS shuffle_idx
FROM lim""")
def q_seeded_shuffle_head(spark, sf_dir):
    """SFT order: limit the train rows (200), then shuffle them with seed 42."""
    from corpusprep.operators.ordering import seeded_shuffle
    from corpusprep.plans.sft import split_and_limit
    docs = table(spark, sf_dir, "documents").select("doc_id")
    lim = split_and_limit(docs, ["doc_id"], percent=5, max_train_samples=200, max_eval_samples=1)
    return seeded_shuffle(lim.where("split = 'train'").select("doc_id"), 42, "doc_id")


@register("token_stats", f"""
WITH {SQL_SPLIT_DOCS.strip()},
t AS (SELECT split, len({sql_ids('text')}) AS n FROM split_docs)
SELECT split, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(n) AS BIGINT) AS n_tokens,
       CAST(max(n) AS BIGINT) AS max_tokens, CAST(min(n) AS BIGINT) AS min_tokens
FROM t GROUP BY split""")
def q_token_stats(spark, sf_dir):
    """Rows, tokens, longest and shortest row per split, from token counts: no id array is built."""
    from corpusprep.functions.tokens import token_count
    from corpusprep.operators.tokenizing import token_stats
    return token_stats(_split_only(spark, sf_dir).select("split", token_count("text").alias("n")), length=F.col("n"))


@register("decode_roundtrip", f"""
SELECT item_id, CAST(len({sql_ids('text')}) AS BIGINT) AS n_tokens,
       array_to_string(list_transform({sql_ids('text')}, lambda i: chr(i - 256)), '') AS decoded
FROM benchmark""")
def q_decode_roundtrip(spark, sf_dir):
    """Benchmark texts tokenized and decoded back: token counts and the decoded text."""
    b = table(spark, sf_dir, "benchmark").select("item_id", codepoint_ids("text").alias("ids"))
    return b.select("item_id", F.size("ids").cast("bigint").alias("n_tokens"), decode_ids("ids").alias("decoded"))


# ------------------------------------------------------------------------------------------------
# instruction examples
# ------------------------------------------------------------------------------------------------

def _triples(spark, sf_dir):
    return derived.instruction_triples(table(spark, sf_dir, "conversations"))


@register("instruction_source", f"""
WITH {SQL_EXCHANGES.strip()}
SELECT conv_id, turn, {SQL_SOURCE} AS source FROM triples""")
def q_instruction_source(spark, sf_dir):
    """Source text of every instruction triple: instruction plus the input when set."""
    from corpusprep.operators.instruct import build_source
    return _triples(spark, sf_dir).select("conv_id", "turn", build_source("instruction", "input").alias("source"))


def sql_instruction(style: str, max_source: int, max_target: int, *, ctes: str = SQL_EXCHANGES,
                    source: str = "triples", keep: str = "conv_id, turn", begin: str = "") -> str:
    limit = max_source + max_target
    if style == "markers":
        ids = "[195] || s || [196] || t"
        labels = f"[2] || {sql_repeat(-100, 'len(s) + 1')} || t"
    else:
        ids = "s || t"
        labels = f"{sql_repeat(-100, 'len(s)')} || t"
    return f"""
WITH {ctes.strip()},
tk AS (SELECT {keep}, {begin}{sql_ids(SQL_SOURCE)} AS s, {sql_ids('output')} || [2] AS t
       FROM {source} WHERE instruction IS NOT NULL AND output IS NOT NULL),
ok AS (SELECT * FROM tk WHERE len(s) <= {max_source} AND len(t) <= {max_target}),
fm AS (SELECT {keep}, list_slice({ids}, 1, {limit}) AS input_ids, list_slice({labels}, 1, {limit}) AS labels FROM ok)
SELECT {keep}, array_to_string(input_ids, ',') AS input_ids, array_to_string(labels, ',') AS labels
FROM fm WHERE len(list_filter(labels, lambda x: x <> -100)) > 0"""


def _instruction_examples(spark, sf_dir, style):
    from corpusprep.operators.instruct import format_instructions
    return format_instructions(_triples(spark, sf_dir), max_source=1024, max_target=1024, style=style,
                               keep=("conv_id", "turn"))


@register("instruction_examples", sql_instruction("markers", 1024, 1024))
def q_instruction_examples(spark, sf_dir):
    """Markers style with the launch limits 1024 / 1024; too long rows dropped."""
    d = _instruction_examples(spark, sf_dir, "markers")
    return d.select("conv_id", "turn", ids_text("input_ids").alias("input_ids"), ids_text("labels").alias("labels"))


@register("instruction_plain", sql_instruction("plain", 1024, 1024))
def q_instruction_plain(spark, sf_dir):
    """The older plain style: source then target ids, the source masked in the labels."""
    d = _instruction_examples(spark, sf_dir, "plain")
    return d.select("conv_id", "turn", ids_text("input_ids").alias("input_ids"), ids_text("labels").alias("labels"))


@register("instruction_special_tokens", sql_instruction("markers", 256, 256, begin="[1] || "))
def q_instruction_special_tokens(spark, sf_dir):
    """A tokenizer with a begin token: the source is encoded with it (and counted with it), the target without."""
    from corpusprep.operators.instruct import format_instructions
    from corpusprep.operators.tokenizing import CodepointTokenizer
    d = format_instructions(_triples(spark, sf_dir), max_source=256, max_target=256, keep=("conv_id", "turn"), tokenizer=CodepointTokenizer(1))
    return d.select("conv_id", "turn", ids_text("input_ids").alias("input_ids"), ids_text("labels").alias("labels"))


@register("display_labels", f"""
WITH fm AS ({sql_instruction("markers", 1024, 1024)})
SELECT conv_id, turn,
       array_to_string(list_transform(string_split(labels, ','), lambda x: CASE
         WHEN CAST(x AS INTEGER) >= 256 THEN chr(CAST(x AS INTEGER) - 256)
         WHEN CAST(x AS INTEGER) = 195 THEN {Q_SQL} WHEN CAST(x AS INTEGER) = 196 THEN {A_SQL}
         WHEN CAST(x AS INTEGER) = 2 THEN '{EOS_TEXT}' ELSE '' END), '') AS label_text
FROM fm""")
def q_display_labels(spark, sf_dir):
    """Labels with the ignore id shown as pad, decoded to text (the answer and its eos)."""
    d = _instruction_examples(spark, sf_dir, "markers")
    return d.select("conv_id", "turn", decode_ids(labels_for_display("labels")).alias("label_text"))


@register("render_template", f"""
WITH {SQL_EXCHANGES.strip()}
SELECT conv_id, turn,
       replace('{TEMPLATE_TEXT}', '{{query}}',
               '{_SYSTEM}' || instruction || CASE WHEN instruction <> '' THEN '{TEMPLATE_SEP}' ELSE '' END || coalesce(input, '')) AS prompt
FROM triples""")
def q_render_template(spark, sf_dir):
    """Instruction and system text rendered through the registered prompt template."""
    from corpusprep.operators.instruct import render_template
    t = _triples(spark, sf_dir).withColumn("source", F.coalesce("input", F.lit("")))
    return render_template(t, TEMPLATE_NAME, instruction="instruction", source="source").select("conv_id", "turn", "prompt")


# ------------------------------------------------------------------------------------------------
# chat examples
# ------------------------------------------------------------------------------------------------

def sql_chat(max_source: int, max_target: int, pad: int = 0) -> str:
    return f"""
WITH msgs AS (SELECT conv_id, turn,
                     CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END AS frm,
                     {sql_ids('text')} AS v FROM conversations),
pieces AS (SELECT conv_id, turn,
                  CASE WHEN frm = 'human' THEN [195] || v ELSE [196] || v END AS pi,
                  CASE WHEN frm = 'human' THEN [2] || list_transform(v, lambda x: -100) ELSE [-100] || v END AS pl
           FROM msgs),
conv AS (SELECT conv_id, flatten(list(pi ORDER BY turn)) || [2] AS ids, flatten(list(pl ORDER BY turn)) || [2] AS labels
         FROM pieces GROUP BY conv_id),
cut AS (SELECT conv_id, list_slice(ids, 1, {max_source}) AS ids, list_slice(labels, 1, {max_target}) AS labels FROM conv),
padded AS (SELECT conv_id, ids || {sql_repeat(pad, f'{max_source} - len(ids)')} AS ids,
                  labels || {sql_repeat(-100, f'{max_target} - len(labels)')} AS labels FROM cut)
SELECT conv_id, array_to_string(ids, ',') AS input_ids, array_to_string(labels, ',') AS labels,
       CAST(len(list_filter(ids, lambda x: x <> {pad})) AS BIGINT) AS n_attended
FROM padded WHERE len(list_filter(labels, lambda x: x <> -100)) > 0"""


def _chat_out(d: DataFrame) -> DataFrame:
    return d.select("conv_id", ids_text("input_ids").alias("input_ids"), ids_text("labels").alias("labels"),
                    F.size(F.filter("attention_mask", lambda x: x)).cast("bigint").alias("n_attended"))


@register("chat_examples", sql_chat(2048, 2048))
def q_chat_examples(spark, sf_dir):
    """Multi-turn chats, launch limits 2048 / 2048; system turns count as answers."""
    from corpusprep.operators.chat import chat_examples
    msgs = derived.chat_messages(table(spark, sf_dir, "conversations"))
    return _chat_out(chat_examples(msgs, max_source=2048, max_target=2048))


@register("chat_examples_short", sql_chat(512, 256))
def q_chat_examples_short(spark, sf_dir):
    """Code defaults shape: unequal limits (ids 512, labels 256) cut most conversations."""
    from corpusprep.operators.chat import chat_examples
    msgs = derived.chat_messages(table(spark, sf_dir, "conversations"))
    return _chat_out(chat_examples(msgs, max_source=512, max_target=256, allow_unequal=True))


@register("chat_eos_pad", sql_chat(512, 512, 2))
def q_chat_eos_pad(spark, sf_dir):
    """A tokenizer without a pad id of its own, padded with eos: real eos tokens are masked too."""
    from corpusprep.operators.chat import chat_examples
    msgs = derived.chat_messages(table(spark, sf_dir, "conversations"))
    return _chat_out(chat_examples(msgs, max_source=512, max_target=512, pad_with_eos=True))


@register("chat_all_masked", sql_chat(64, 1))
def q_chat_all_masked(spark, sf_dir):
    """Labels cut to one: of a conversation that does not start with a human turn only the marker's -100 is left, and it goes."""
    from corpusprep.operators.chat import chat_examples
    msgs = derived.chat_messages(table(spark, sf_dir, "conversations"))
    return _chat_out(chat_examples(msgs, max_source=64, max_target=1, allow_unequal=True))


# ------------------------------------------------------------------------------------------------
# preference pairs
# ------------------------------------------------------------------------------------------------

def _pairs(spark, sf_dir):
    return derived.preference_pairs(table(spark, sf_dir, "conversations"))


@register("wrap_prompt", f"""
WITH {SQL_EXCHANGES.strip()}
SELECT conv_id, turn, {Q_SQL} || prompt || {A_SQL} AS prompt, chosen, rejected FROM pairs""")
def q_wrap_prompt(spark, sf_dir):
    """Preference prompts wrapped in the question and answer marker texts."""
    from corpusprep.operators.preference import wrap_prompt
    return wrap_prompt(_pairs(spark, sf_dir), keep=("conv_id", "turn"))


@register("pair_length_filter", f"""
WITH {SQL_EXCHANGES.strip()},
w AS (SELECT conv_id, turn, {Q_SQL} || prompt || {A_SQL} AS prompt, chosen, rejected FROM pairs)
SELECT conv_id, turn, prompt, chosen, rejected
FROM w WHERE length(prompt) + length(chosen) <= 1024 AND length(prompt) + length(rejected) <= 1024""")
def q_pair_length_filter(spark, sf_dir):
    """Wrapped pairs kept when prompt + chosen and prompt + rejected fit 1024 characters."""
    from corpusprep.operators.preference import filter_pair_length, wrap_prompt
    return filter_pair_length(wrap_prompt(_pairs(spark, sf_dir), keep=("conv_id", "turn")), 1024)


@register("pair_sanity_head", f"""
WITH {SQL_EXCHANGES.strip()},
h AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS rn FROM pairs) AS x WHERE rn <= 200),
w AS (SELECT conv_id, turn, {Q_SQL} || prompt || {A_SQL} AS prompt, chosen, rejected FROM h)
SELECT conv_id, turn, prompt FROM w WHERE length(prompt) + length(chosen) <= 4096 AND length(prompt) + length(rejected) <= 4096""")
def q_pair_sanity_head(spark, sf_dir):
    """Sanity mode: the first 200 pairs before formatting and filtering (launch limit 4096)."""
    from corpusprep.constants import SANITY_ROWS_PAIRS
    from corpusprep.operators.ordering import head_rows
    from corpusprep.operators.preference import filter_pair_length, wrap_prompt
    p = head_rows(_pairs(spark, sf_dir), ["conv_id", "turn"], SANITY_ROWS_PAIRS)
    w = filter_pair_length(wrap_prompt(p, keep=("conv_id", "turn")), 4096)
    return w.select("conv_id", "turn", "prompt")


SQL_TRANSCRIPTS = f"""
prev AS (SELECT conv_id, turn + 2 AS turn, {NL2} || 'Human: ' || usr || {NL2} || 'Assistant: ' || answer AS history FROM ex),
tr AS (SELECT p.conv_id, p.turn, coalesce(h.history, '') || {NL2} || 'Human: ' || p.prompt || {NL2} || 'Assistant: ' AS head,
              p.chosen, p.rejected FROM pairs p LEFT JOIN prev h USING (conv_id, turn)),
t2 AS (SELECT conv_id, turn, head || chosen AS c, head || rejected AS r FROM tr)"""


@register("transcript_sanity_head", f"""
WITH {SQL_EXCHANGES.strip()}, {SQL_TRANSCRIPTS.strip()},
h AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS rn FROM t2) AS x WHERE rn <= 1000),
t3 AS (SELECT *, length(c) - length(string_split(c, {NL2} || 'Assistant:')[-1]) AS plen FROM h)
SELECT conv_id, turn, left(c, plen) AS prompt, substr(c, plen + 1) AS chosen, substr(r, plen + 1) AS rejected,
       starts_with(r, left(c, plen)) AS prefix_ok
FROM t3""")
def q_transcript_sanity_head(spark, sf_dir):
    """Sanity mode of the transcript loader: the first 1000 dialogues, then split."""
    from corpusprep.plans.preference import prepare_transcripts
    t = derived.transcripts(table(spark, sf_dir, "conversations"))
    return prepare_transcripts(t, order_by=["conv_id", "turn"], sanity=True, keep=("conv_id", "turn"),
                               bucket_key=_pair_key())


@register("pairs_from_csv_sanity", f"""
WITH {SQL_EXCHANGES.strip()},
h AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS rn FROM pairs) AS x WHERE rn <= 200),
w AS (SELECT {Q_SQL} || prompt || {A_SQL} AS prompt, chosen, rejected FROM h)
SELECT prompt, chosen, rejected FROM w
WHERE length(prompt) + length(chosen) <= 4096 AND length(prompt) + length(rejected) <= 4096""")
def q_pairs_from_csv_sanity(spark, sf_dir):
    """Preference CSV files written in (conv_id, turn) order, read back in file order; sanity
    mode keeps the first 200 pairs before wrapping and filtering."""
    from corpusprep.plans.preference import pairs_from_csv
    path = _scratch(spark, "pairs-csv-files")
    _pairs(spark, sf_dir).repartitionByRange(3, "conv_id", "turn").sortWithinPartitions("conv_id", "turn") \
        .select("prompt", "chosen", "rejected").write.mode("overwrite") \
        .option("header", "true").option("escape", '"').option("quoteAll", "true").csv(path)
    out = pairs_from_csv(spark, path, sanity=True, max_length=4096)
    return out.select("prompt", "chosen", "rejected")


@register("transcript_split", f"""
WITH {SQL_EXCHANGES.strip()},
prev AS (SELECT conv_id, turn + 2 AS turn, {NL2} || 'Human: ' || usr || {NL2} || 'Assistant: ' || answer AS history FROM ex),
tr AS (SELECT p.conv_id, p.turn, coalesce(h.history, '') || {NL2} || 'Human: ' || p.prompt || {NL2} || 'Assistant: ' AS head,
              p.chosen, p.rejected FROM pairs p LEFT JOIN prev h USING (conv_id, turn)),
t2 AS (SELECT conv_id, turn, head || chosen AS c, head || rejected AS r FROM tr),
t3 AS (SELECT *, length(c) - length(string_split(c, {NL2} || 'Assistant:')[-1]) AS plen FROM t2)
SELECT conv_id, turn, left(c, plen) AS prompt, substr(c, plen + 1) AS chosen, substr(r, plen + 1) AS rejected,
       starts_with(r, left(c, plen)) AS prefix_ok
FROM t3""")
def q_transcript_split(spark, sf_dir):
    """Whole dialogues split at the last assistant marker into prompt, chosen and rejected."""
    from corpusprep.operators.preference import split_transcripts
    t = derived.transcripts(table(spark, sf_dir, "conversations"))
    return split_transcripts(t, keep=("conv_id", "turn"))


# ------------------------------------------------------------------------------------------------
# batches
# ------------------------------------------------------------------------------------------------

SQL_BATCHES = f"""
bt AS (SELECT doc_id, source, text, idx // 8 AS batch_no, idx % 8 AS pos FROM (
         SELECT doc_id, source, text, row_number() OVER (ORDER BY {SQL_SHUFFLE_KEY.format(seed=42, col='doc_id')}, doc_id) - 1 AS idx
         FROM documents) AS s)"""


def _batches(spark, sf_dir):
    from corpusprep.operators.batching import assign_batches
    return assign_batches(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), 8, 42, "doc_id")


@register("batches", f"WITH {SQL_BATCHES.strip()} SELECT doc_id, CAST(batch_no AS BIGINT) AS batch_no, "
                     "CAST(pos AS BIGINT) AS pos FROM bt")
def q_batches(spark, sf_dir):
    """Seeded shuffle of all documents cut in batches of 8."""
    return _batches(spark, sf_dir).select("doc_id", "batch_no", "pos")


@register("skip_batches", f"WITH {SQL_BATCHES.strip()} SELECT doc_id, CAST(batch_no AS BIGINT) AS batch_no, "
                          "CAST(pos AS BIGINT) AS pos FROM bt WHERE batch_no >= 10")
def q_skip_batches(spark, sf_dir):
    """Resuming inside an epoch: the first 10 batches left out."""
    from corpusprep.operators.batching import skip_batches
    return skip_batches(_batches(spark, sf_dir), 10).select("doc_id", "batch_no", "pos")


@register("collate_fallback", f"""
WITH {SQL_BATCHES.strip()},
ex AS (SELECT bt.batch_no, bt.pos, {sql_ids('bt.text')} AS input_ids, l.quality AS label
       FROM bt LEFT JOIN labels l USING (doc_id)),
w AS (SELECT *,
        first_value(input_ids) OVER (PARTITION BY batch_no ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_ids,
        first_value(label) OVER (PARTITION BY batch_no ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_label,
        min(len(input_ids)) OVER (PARTITION BY batch_no) <> max(len(input_ids)) OVER (PARTITION BY batch_no) AS fell_back
      FROM ex)
SELECT CAST(batch_no AS BIGINT) AS batch_no, CAST(pos AS BIGINT) AS pos,
       array_to_string(CASE WHEN fell_back THEN first_ids ELSE input_ids END, ',') AS input_ids,
       CAST(CASE WHEN first_label IS NOT NULL THEN label END AS BIGINT) AS labels, fell_back
FROM w""")
def q_collate_fallback(spark, sf_dir):
    """Ragged batches become copies of their first row; labels from the first row's type and
    presence; the string column is not collated."""
    from corpusprep.operators.batching import collate
    b = _batches(spark, sf_dir)
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    ex = b.join(lab, on="doc_id", how="left").select("batch_no", "pos", "text", F.length("text").alias("n"), "label", F.col("source").alias("name"))
    c = collate(ex, on_ragged="repeat_first", lengths={"input_ids": "n"}, derived={"input_ids": codepoint_ids("text")})
    return c.select("batch_no", "pos", ids_text("input_ids").alias("input_ids"), "labels", "fell_back")


@register("collate_batches", ORACLE["collate_fallback"])
def q_collate_batches(spark, sf_dir):
    """The same collation with batching fused in: whole rows shuffled once, by id (``collate_by_id``)."""
    from corpusprep.operators.batching import collate_by_id
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    ex = docs.join(lab, on="doc_id", how="left").select(
        "doc_id", "text", F.length("text").alias("n"), "label", F.col("source").alias("name"))
    c = collate_by_id(ex, 8, 42, "doc_id", on_ragged="repeat_first", lengths={"input_ids": "n"}, derived={"input_ids": codepoint_ids("text")})
    return c.select("batch_no", "pos", ids_text("input_ids").alias("input_ids"), "labels", "fell_back")


@register("pad_to_longest", f"""
WITH {SQL_BATCHES.strip()},
ex AS (SELECT batch_no, pos, {sql_ids('text')} AS ids FROM bt),
w AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_no) AS m FROM ex)
SELECT CAST(batch_no AS BIGINT) AS batch_no, CAST(pos AS BIGINT) AS pos,
       array_to_string(ids || {sql_repeat(0, 'm - len(ids)')}, ',') AS input_ids,
       array_to_string(ids || {sql_repeat(-100, 'm - len(ids)')}, ',') AS labels
FROM w""")
def q_pad_to_longest(spark, sf_dir):
    """Batches of 8 padded to their longest row: ids with pad 0, labels with -100."""
    from corpusprep.operators.batching import pad_to_longest
    b = _batches(spark, sf_dir).select("batch_no", "pos", "text", F.length("text").alias("n"))
    p = pad_to_longest(b, lengths={"input_ids": "n", "labels": "n"}, derived=dict.fromkeys(("input_ids", "labels"), codepoint_ids("text")))
    return p.select("batch_no", "pos", ids_text("input_ids").alias("input_ids"), ids_text("labels").alias("labels"))


@register("collate_batches_padded", ORACLE["pad_to_longest"])
def q_collate_batches_padded(spark, sf_dir):
    """Batching and padding to the longest row of each batch in one shuffle
    (``collate_by_id(on_ragged='pad')``): ids padded with 0, labels with -100."""
    from corpusprep.operators.batching import collate_by_id
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.length("text").alias("n"))
    c = collate_by_id(docs, 8, 42, "doc_id", on_ragged="pad", lengths={"input_ids": "n", "labels": "n"},
                        derived=dict.fromkeys(("input_ids", "labels"), codepoint_ids("text")))
    return c.select("batch_no", "pos", ids_text("input_ids").alias("input_ids"), ids_text("labels").alias("labels"))


@register("epoch_plan", f"""
WITH {SQL_SPLIT_DOCS.strip()},
n AS (SELECT split, count(*) AS n_examples FROM split_docs GROUP BY split),
b AS (SELECT *, CAST(ceil(n_examples / 8.0) AS BIGINT) AS batches FROM n),
u AS (SELECT *, CAST(ceil(batches / 4.0) AS BIGINT) AS updates_per_epoch FROM b)
SELECT split, CAST(n_examples AS BIGINT) AS n_examples, batches, updates_per_epoch,
       CAST(updates_per_epoch * 3 AS BIGINT) AS total_updates,
       CAST(CASE WHEN updates_per_epoch > 0 THEN ceil(updates_per_epoch * 3 / updates_per_epoch) END AS BIGINT) AS epochs,
       CAST(32 AS BIGINT) AS total_batch_size
FROM u""")
def q_epoch_plan(spark, sf_dir):
    """Batch size 8, accumulation 4, 3 epochs, one process."""
    from corpusprep.operators.batching import epoch_plan
    return epoch_plan(_split_only(spark, sf_dir), 8, accumulation=4, epochs=3)


# ------------------------------------------------------------------------------------------------
# run logs
# ------------------------------------------------------------------------------------------------

def _train_log(spark, sf_dir):
    return derived.train_log(table(spark, sf_dir, "events"))


def _evals(spark, sf_dir):
    from corpusprep.operators.runlog import eval_loss
    return eval_loss(derived.eval_log(table(spark, sf_dir, "events")), exact_scale=4)


@register("completed_steps", f"""
WITH {SQL_TRAIN_LOG.strip()}
SELECT run, epoch, micro_step, sync, CAST(completed_steps AS BIGINT) AS completed_steps FROM cs""")
def q_completed_steps(spark, sf_dir):
    """Optimizer steps completed at every micro-step of the derived run log (one per gradient sync)."""
    from corpusprep.operators.runlog import completed_steps
    return completed_steps(_train_log(spark, sf_dir)).select("run", "epoch", "micro_step", "sync", "completed_steps")


@register("running_train_loss", f"""
WITH {SQL_TRAIN_LOG.strip()},
r AS (SELECT *, sum(CAST(loss AS DECIMAL(38,4))) OVER (PARTITION BY run, epoch ORDER BY micro_step
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS els FROM cs)
SELECT run, epoch, micro_step, CAST(completed_steps AS BIGINT) AS completed_steps,
       CAST(els AS DOUBLE) AS epoch_loss_sum,
       CASE WHEN completed_steps > 0 THEN CAST(els AS DOUBLE) / CAST(completed_steps AS DOUBLE) END AS train_loss
FROM r""")
def q_running_train_loss(spark, sf_dir):
    """Epoch loss sum over completed steps of all epochs, as the reference logs it."""
    from corpusprep.operators.runlog import running_train_loss
    d = running_train_loss(_train_log(spark, sf_dir), exact_scale=4)
    return d.select("run", "epoch", "micro_step", "completed_steps", "epoch_loss_sum", "train_loss")


@register("cadence", f"""
WITH {SQL_TRAIN_LOG.strip()}
SELECT run, CAST(completed_steps AS BIGINT) AS completed_steps, min(micro_step) AS micro_step,
       arg_min(epoch, micro_step) AS epoch
FROM cs WHERE completed_steps > 0 AND completed_steps % 10 = 0 GROUP BY run, completed_steps""")
def q_cadence(spark, sf_dir):
    """Evaluation points every 10 optimizer steps, once each."""
    from corpusprep.operators.runlog import cadence, completed_steps
    return cadence(completed_steps(_train_log(spark, sf_dir)), 10).select("run", "completed_steps", "micro_step", "epoch")


@register("eval_loss_perplexity", f"""
WITH {SQL_EVALS.strip()}
SELECT run, epoch, completed_steps, n_examples, eval_loss, round(exp(eval_loss), 6) AS perplexity FROM evals""")
def q_eval_loss_perplexity(spark, sf_dir):
    """Example-weighted mean eval loss and its perplexity per evaluation."""
    e = _evals(spark, sf_dir)
    return e.select("run", "epoch", "completed_steps", "n_examples", "eval_loss",
                    F.round("perplexity", 6).alias("perplexity"))


@register("best_so_far", f"""
WITH {SQL_EVALS.strip()},
b AS (SELECT *, min(eval_loss) OVER (PARTITION BY run ORDER BY completed_steps
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM evals)
SELECT run, completed_steps, eval_loss, best_before,
       (best_before IS NULL OR eval_loss < best_before) AS is_best
FROM b""")
def q_best_so_far(spark, sf_dir):
    """Per run, whether each evaluation is strictly better than all before it (two-level running minimum)."""
    from corpusprep.operators.runlog import best_so_far
    return best_so_far(_evals(spark, sf_dir)).select("run", "completed_steps", "eval_loss", "best_before", "is_best")


@register("epoch_summary", f"""
WITH {SQL_EVALS.strip()},
pe AS (SELECT run, epoch, max(completed_steps) AS completed_steps, arg_max(eval_loss, completed_steps) AS eval_loss
       FROM evals GROUP BY run, epoch)
SELECT run, epoch, completed_steps, eval_loss, round(exp(eval_loss), 6) AS perplexity,
       epoch = max(epoch) OVER (PARTITION BY run) AS is_final
FROM pe""")
def q_epoch_summary(spark, sf_dir):
    """Per run and epoch: the last evaluation's loss and perplexity, and which epoch is final."""
    from corpusprep.operators.runlog import epoch_summary
    s = epoch_summary(_evals(spark, sf_dir))
    return s.select("run", "epoch", "completed_steps", "eval_loss", F.round("perplexity", 6).alias("perplexity"), "is_final")


SQL_SAVES = """
saves AS (SELECT run, completed_steps, min(micro_step) AS micro_step FROM cs
          WHERE completed_steps > 0 AND completed_steps % 5 = 0 GROUP BY run, completed_steps)"""


def _saves(spark, sf_dir):
    from corpusprep.operators.runlog import cadence, completed_steps
    return cadence(completed_steps(_train_log(spark, sf_dir)), 5, keep=())


@register("checkpoint_ring", f"""
WITH {SQL_TRAIN_LOG.strip()}, {SQL_SAVES.strip()}
SELECT run, CAST(floor(completed_steps / 5) % 5 AS BIGINT) AS slot, CAST(max(completed_steps) AS BIGINT) AS completed_steps,
       'last_step_' || CAST(CAST(floor(completed_steps / 5) % 5 AS BIGINT) AS VARCHAR) AS name
FROM saves GROUP BY run, floor(completed_steps / 5) % 5""")
def q_checkpoint_ring(spark, sf_dir):
    """Saves every 5 optimizer steps into a ring of 5 slots: the survivors."""
    from corpusprep.operators.runlog import checkpoint_ring
    return checkpoint_ring(_saves(spark, sf_dir), 5).select("run", "slot", "completed_steps", "name")


@register("resume_point", f"""
WITH {SQL_TRAIN_LOG.strip()}, {SQL_SAVES.strip()},
names AS (SELECT run, 'step_' || CAST(completed_steps AS VARCHAR) AS name FROM saves
          UNION ALL SELECT DISTINCT run, 'epoch_' || CAST(epoch AS VARCHAR) FROM train_log
          UNION ALL SELECT DISTINCT run, 'last_step_' || CAST(CAST(floor(completed_steps / 5) % 5 AS BIGINT) AS VARCHAR) FROM saves),
p AS (SELECT run, name, regexp_extract(name, '^epoch_([0-9]+)$', 1) AS ep, regexp_extract(name, '^step_([0-9]+)$', 1) AS st FROM names)
SELECT run, name,
       CAST(CASE WHEN ep <> '' THEN CAST(ep AS BIGINT) + 1
                 WHEN st <> '' THEN floor(CAST(st AS BIGINT) * {derived.ACCUMULATION} / {derived.STEPS_PER_EPOCH}) END AS BIGINT) AS start_epoch,
       CAST(CASE WHEN ep <> '' THEN (CAST(ep AS BIGINT) + 1) * 8
                 WHEN st <> '' THEN floor(CAST(st AS BIGINT) * {derived.ACCUMULATION} / {derived.ACCUMULATION}) END AS BIGINT) AS completed_steps,
       CAST(CASE WHEN ep <> '' THEN 0
                 WHEN st <> '' THEN CAST(st AS BIGINT) * {derived.ACCUMULATION}
                      - floor(CAST(st AS BIGINT) * {derived.ACCUMULATION} / {derived.STEPS_PER_EPOCH}) * {derived.STEPS_PER_EPOCH} END AS BIGINT) AS skip_batches,
       CASE WHEN ep = '' AND st = '' THEN 'unparsable checkpoint name' END AS reason
FROM p""")
def q_resume_point(spark, sf_dir):
    """Resume positions for every checkpoint name the run leaves: ``step_N``, ``epoch_N`` and
    the ring's own ``last_step_k`` (not parsable, as in the reference)."""
    from corpusprep.operators.runlog import checkpoint_ring, resume_point
    tl = _train_log(spark, sf_dir)
    saves = _saves(spark, sf_dir)
    names = (saves.select("run", F.concat(F.lit("step_"), F.col("completed_steps").cast("string")).alias("name"))
             .unionByName(tl.select("run", F.concat(F.lit("epoch_"), F.col("epoch").cast("string")).alias("name")).distinct())
             .unionByName(checkpoint_ring(saves, 5).select("run", "name")))
    per_epoch = -(-derived.STEPS_PER_EPOCH // derived.ACCUMULATION)
    r = resume_point(names, accum=derived.ACCUMULATION, batches_per_epoch=derived.STEPS_PER_EPOCH,
                     updates_per_epoch=per_epoch)
    return r.select("run", "name", "start_epoch", "completed_steps", "skip_batches", "reason")


@register("argmax_prediction", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS prediction FROM embeddings""")
def q_argmax_prediction(spark, sf_dir):
    """Index of the largest logit per vector, the first one on ties."""
    from corpusprep.operators.runlog import argmax_prediction
    return argmax_prediction(table(spark, sf_dir, "embeddings"), "embedding").select("vec_id", "prediction")


@register("next_token_accuracy", f"""
WITH p AS (SELECT vec_id, vec_id // {derived.SEQUENCE_LENGTH} AS seq, label,
                  list_position(embedding, list_max(embedding)) - 1 AS pred FROM embeddings),
r AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY vec_id) AS i FROM p),
hits AS (SELECT CAST(a.pred = b.label AS INTEGER) AS hit FROM r a JOIN r b ON a.seq = b.seq AND b.i = a.i + 1)
SELECT CAST(sum(hit) AS BIGINT) AS correct, CAST(count(*) AS BIGINT) AS compared,
       CAST(sum(hit) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS accuracy
FROM hits""")
def q_next_token_accuracy(spark, sf_dir):
    """Share of positions where the next label equals the prediction, over all sequences."""
    from corpusprep.operators.runlog import next_token_accuracy
    return next_token_accuracy(derived.logit_sequences(table(spark, sf_dir, "embeddings")))


# ------------------------------------------------------------------------------------------------
# files and streams: the query writes files derived from the tables to a fresh folder under the
# shared checkpoint folder, then reads them back with the corpus readers
# ------------------------------------------------------------------------------------------------

def _scratch(spark, name):
    from corpusprep.session import scratch_path
    return scratch_path(spark, name)


def _by_id(docs: DataFrame) -> DataFrame:
    """``docs`` in ``doc_id`` order, one file for each range. Spark sizes the ranges, so that no task reads a fixed share of all rows; there are
    at most as many as ``pack_stream`` takes in one micro-batch."""
    most = 1000
    few = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")) <= most
    return (docs.repartitionByRange("doc_id") if few else docs.repartitionByRange(most, "doc_id")).sortWithinPartitions("doc_id")


def _write_docs(split_docs: DataFrame, base: str, fmt: str) -> None:
    """Train and validation documents in doc_id order, train nested by language."""
    for split in ("train", "validation"):
        d = _by_id(split_docs.where(F.col("split") == split))
        if fmt == "text":
            w = d.select("text", "lang").write.mode("overwrite")
            (w.partitionBy("lang") if split == "train" else d.select("text").write.mode("overwrite")).text(f"{base}/{split}")
        else:
            d.select("doc_id", "text", "lang").write.mode("overwrite").json(f"{base}/{split}")


@register("read_text_corpus", f"""
WITH {SQL_SPLIT_DOCS.strip()}
SELECT split, CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS n_lines,
       CAST(sum(length(text) + 1) AS BIGINT) AS n_chars
FROM split_docs GROUP BY split""")
def q_read_text_corpus(spark, sf_dir):
    """Documents written as .txt files (train in nested folders), discovered recursively,
    type-checked and read one row per line with line breaks kept."""
    from corpusprep.sources.files import read_corpus
    base = _scratch(spark, "text-corpus")
    _write_docs(_split_only(spark, sf_dir), base, "text")
    from corpusprep.operators.ordering import choose_validation
    parts = read_corpus(spark, f"{base}/train", f"{base}/validation", keep_linebreaks=True)
    rows = choose_validation(parts["train"], parts.get("validation"))
    return rows.groupBy("split").agg(F.count(F.lit(1)).cast("bigint").alias("n_lines"),
                                     F.sum(F.length("text")).cast("bigint").alias("n_chars"))


@register("read_json_corpus", f"""
WITH {SQL_SPLIT_DOCS.strip()}
SELECT split, CAST(row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS BIGINT) AS row_idx, doc_id,
       CAST(length(text) AS BIGINT) AS n_chars
FROM split_docs""")
def q_read_json_corpus(spark, sf_dir):
    """Documents written as JSON lines and read back in file order: the file position key
    must give every row its original place."""
    from corpusprep.operators.ordering import row_index
    from corpusprep.sources.files import read_corpus
    from pyspark.sql import types as T
    base = _scratch(spark, "json-corpus")
    _write_docs(_split_only(spark, sf_dir), base, "json")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    parts = read_corpus(spark, f"{base}/train", f"{base}/validation", schema=schema)
    out = None
    for split, df in parts.items():
        idx = row_index(df, ["file_rank", "file_block", "file_row"], bucket_key=F.col("file_pos"))
        idx = idx.select(F.lit(split).alias("split"), "row_idx", "doc_id", F.length("text").cast("bigint").alias("n_chars"))
        out = idx if out is None else out.unionByName(idx)
    return out


@register("read_numbered_corpus", f"""
WITH {SQL_SPLIT_DOCS.strip()}
SELECT split, CAST(row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS BIGINT) AS row_idx, doc_id,
       CAST(length(text) AS BIGINT) AS n_chars
FROM split_docs""")
def q_read_numbered_corpus(spark, sf_dir):
    """JSON lines read by folder and numbered once through the manifest table: no file list in Python."""
    from corpusprep.sources.files import read_numbered
    from pyspark.sql import types as T
    base = _scratch(spark, "numbered-corpus")
    _write_docs(_split_only(spark, sf_dir), base, "json")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    rows = read_numbered(spark, {"train": f"{base}/train", "validation": f"{base}/validation"}, schema=schema)
    return rows.select("split", "row_idx", "doc_id", F.length("text").cast("bigint").alias("n_chars"))


@register("csv_pairs", f"""
WITH {SQL_EXCHANGES.strip()},
w AS (SELECT {Q_SQL} || prompt || {A_SQL} AS prompt, chosen, rejected FROM pairs)
SELECT prompt, chosen, rejected FROM w
WHERE length(prompt) + length(chosen) <= 4096 AND length(prompt) + length(rejected) <= 4096""")
def q_csv_pairs(spark, sf_dir):
    """Preference pairs through a CSV file (quoted newlines and quotes), wrapped and length
    filtered with the launch limit 4096."""
    from corpusprep.operators.preference import filter_pair_length, wrap_prompt
    from corpusprep.sources.files import read_pairs_csv
    path = _scratch(spark, "pairs-csv")
    _pairs(spark, sf_dir).select("prompt", "chosen", "rejected").write.mode("overwrite") \
        .option("header", "true").option("escape", '"').option("quoteAll", "true").csv(path)
    return filter_pair_length(wrap_prompt(read_pairs_csv(spark, path)), 4096)


@register("write_and_reuse", f"""
SELECT batch_id, block_no, n_tokens, ids, true AS reused
FROM ({sql_pack(1024, 1000)}) AS p WHERE split = 'validation'""")
def q_write_and_reuse(spark, sf_dir):
    """Prepared blocks stored partitioned by split, reused on the second call with the same
    parameters and input, and one split read back."""
    from corpusprep.plans.pretrain import pretrain_blocks
    from corpusprep.sources.files import read_split
    from corpusprep.sources.sinks import write_prepared
    path = _scratch(spark, "prepared")
    docs = table(spark, sf_dir, "documents")
    params = {"block_size": 1024, "rows_per_batch": 1000, "percent": 5, "tokenizer": "codepoint"}
    blocks = pretrain_blocks(docs, ["doc_id"], block_size=1024, rows_per_batch=1000, by_split=True)
    write_prepared(blocks, path, params=params, input_files=docs.inputFiles())
    _, reused = write_prepared(blocks, path, params=params, input_files=docs.inputFiles())
    v = read_split(spark, path, "validation")
    return v.select(F.col("batch_id").cast("bigint"), F.col("block_no").cast("bigint"),
                    F.size("input_ids").cast("bigint").alias("n_tokens"), ids_text("input_ids").alias("ids"),
                    F.lit(reused).alias("reused"))


@register("prepare_stream", sql_instruction("markers", 1024, 1024))
def q_prepare_stream(spark, sf_dir):
    """Instruction triples arriving as JSON files, formatted by a Structured Streaming query
    (availableNow trigger, parquet sink with checkpoint); equals the batch result."""
    from pyspark.sql import types as T
    from corpusprep.operators.instruct import format_instructions
    from corpusprep.streaming.prepare import prepare_stream
    base = _scratch(spark, "stream-instructions")
    _triples(spark, sf_dir).repartition(4).write.mode("overwrite").json(f"{base}/in")
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType())]
                          + [T.StructField(c, T.StringType()) for c in ("instruction", "input", "output")])
    q = prepare_stream(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint",
                       lambda df: format_instructions(df, max_source=1024, max_target=1024, keep=("conv_id", "turn")),
                       schema)
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.select("conv_id", "turn", ids_text("input_ids").alias("input_ids"), ids_text("labels").alias("labels"))


SQL_ALL_DOCS = """
split_docs AS (SELECT doc_id, text, 'all' AS split, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM documents)"""


@register("pack_numbered_stream", sql_pack(1024, 100))
def q_pack_numbered_stream(spark, sf_dir):
    """Numbered documents arriving in an order of their own, two files a trigger: open row batches are carried in the state
    store (``pack_numbered_stream``), and the last, open batch of each split comes from the store itself."""
    from pyspark.sql import types as T
    from corpusprep.streaming.prepare import open_batches, pack_numbered_stream
    base = _scratch(spark, "stream-numbered")
    rows = _split_docs(spark, sf_dir).select("split", "row_idx", "text")
    rows.repartition(6).write.json(f"{base}/in")  # round robin: every file holds rows of every batch
    schema = T.StructType([T.StructField("split", T.StringType()), T.StructField("row_idx", T.LongType()), T.StructField("text", T.StringType())])
    pack_numbered_stream(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", block_size=1024, rows_per_batch=100, schema=schema,
                         split_col="split", max_files_per_trigger=2).awaitTermination()
    columns = ["split", "batch_id", "block_no", "input_ids", "labels"]
    late = open_batches(spark, f"{base}/checkpoint", 1024, split_col="split").where(F.col("input_ids").isNotNull())
    return _blocks_out(spark.read.parquet(f"{base}/out").select(*columns).unionByName(late.select(*columns)))


@register("pack_stream", sql_pack(1024, 100, split_docs=SQL_ALL_DOCS, with_split=False))
def q_pack_stream(spark, sf_dir):
    """Documents arriving as JSON files in doc_id order, tokenized and packed per micro-batch
    in ``foreachBatch`` (blocks of 1024, batches of 100 rows)."""
    from corpusprep.streaming.prepare import pack_stream
    base = _scratch(spark, "stream-pack")
    docs = table(spark, sf_dir, "documents")
    _by_id(docs).select("text").write.mode("overwrite").json(f"{base}/in")
    q = pack_stream(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", block_size=1024, rows_per_batch=100)
    q.awaitTermination()
    b = spark.read.parquet(f"{base}/out")
    return b.select(F.col("batch_id").cast("bigint"), F.col("block_no").cast("bigint"),
                    F.size("input_ids").cast("bigint").alias("n_tokens"), ids_text("input_ids").alias("ids"),
                    (F.col("labels") == F.col("input_ids")).alias("labels_same"))


# ------------------------------------------------------------------------------------------------
# end-to-end plans
# ------------------------------------------------------------------------------------------------

SQL_SFT_ROWS = SQL_EXCHANGES.strip() + f""",
ordered AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS gidx,
                   CAST(round_even(count(*) OVER () * 5 / 100.0, 0) AS BIGINT) AS cut FROM triples),
sp AS (SELECT *, CASE WHEN gidx < cut THEN 'validation' ELSE 'train' END AS split,
              CASE WHEN gidx < cut THEN gidx ELSE gidx - cut END AS row_idx FROM ordered),
lim AS (SELECT * FROM sp),
pos_rows AS (SELECT *, CASE WHEN split = 'train'
                            THEN row_number() OVER (PARTITION BY split ORDER BY {SQL_SHUFFLE_KEY.format(seed=42, col='row_idx')}, row_idx) - 1
                            ELSE row_idx END AS position FROM lim)"""


def _pair_key():
    return F.col("conv_id").cast("double") + F.col("turn").cast("double") / F.lit(2.0 ** 31)


def _sft(spark, sf_dir):
    from corpusprep.plans.sft import prepare_instructions
    return prepare_instructions(_triples(spark, sf_dir), ["conv_id", "turn"], bucket_key=_pair_key(),
                                seed=42, max_source=1024, max_target=1024, keep=("conv_id", "turn"))


@register("sft_prepare", sql_instruction("markers", 1024, 1024, ctes=SQL_SFT_ROWS, source="pos_rows",
                                         keep="split, position, conv_id, turn"))
def q_sft_prepare(spark, sf_dir):
    """Instruction pairs end to end over the whole table: 5% head validation, train shuffled
    with seed 42, formatted with limits 1024 / 1024, fully masked rows dropped."""
    ex, _ = _sft(spark, sf_dir)
    return ex.select("split", "position", "conv_id", "turn", ids_text("input_ids").alias("input_ids"),
                     ids_text("labels").alias("labels"))


@register("sft_from_files", sql_instruction("markers", 1024, 1024, ctes=SQL_SFT_ROWS, source="pos_rows",
                                            keep="split, position, conv_id, turn"))
def q_sft_from_files(spark, sf_dir):
    """The same preparation starting from JSON-lines files (written in (conv_id, turn) order):
    discovery, type check, file-order row index, then split / shuffle / format."""
    from pyspark.sql import types as T
    from corpusprep.plans.sft import instructions_from_files
    base = _scratch(spark, "sft-files")
    _triples(spark, sf_dir).repartitionByRange(4, "conv_id", "turn").sortWithinPartitions("conv_id", "turn") \
        .write.mode("overwrite").json(f"{base}/train")
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType())]
                          + [T.StructField(c, T.StringType()) for c in ("instruction", "input", "output")])
    ex, _ = instructions_from_files(spark, f"{base}/train", schema=schema, seed=42, max_source=1024,
                                    max_target=1024, keep=("conv_id", "turn"))
    return ex.select("split", "position", "conv_id", "turn", ids_text("input_ids").alias("input_ids"),
                     ids_text("labels").alias("labels"))


@register("sft_sample_counts", f"""
WITH {SQL_SFT_ROWS}
SELECT split, CAST(count(*) AS BIGINT) AS samples FROM lim GROUP BY split""")
def q_sft_sample_counts(spark, sf_dir):
    """Sample counts the fine-tuning metrics report: taken before the length filter."""
    _, counts = _sft(spark, sf_dir)
    return counts


SQL_DPO_ROWS = SQL_EXCHANGES.strip() + f""",
ordered AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS gidx,
                   CAST(round_even(count(*) OVER () * 5 / 100.0, 0) AS BIGINT) AS cut FROM pairs),
w AS (SELECT CASE WHEN gidx < cut THEN 'validation' ELSE 'train' END AS split, conv_id, turn,
             {Q_SQL} || prompt || {A_SQL} AS prompt, chosen, rejected FROM ordered)"""


def _dpo(spark, sf_dir, filter_eval):
    from corpusprep.operators.ordering import head_percent_split
    from corpusprep.plans.preference import prepare_pairs
    p = head_percent_split(_pairs(spark, sf_dir), ["conv_id", "turn"], 5, bucket_key=_pair_key(), keep_index=False)
    out = prepare_pairs(p.where("split = 'train'").drop("split"), p.where("split = 'validation'").drop("split"),
                        max_length=1024, filter_eval=filter_eval, keep=("conv_id", "turn"))
    return out.select("split", "conv_id", "turn", "prompt", "chosen", "rejected")


SQL_DPO_OUT = "SELECT split, conv_id, turn, prompt, chosen, rejected FROM w"
SQL_DPO_LEN = "length(prompt) + length(chosen) <= 1024 AND length(prompt) + length(rejected) <= 1024"


@register("dpo_prepare", f"WITH {SQL_DPO_ROWS} {SQL_DPO_OUT} WHERE {SQL_DPO_LEN}")
def q_dpo_prepare(spark, sf_dir):
    """Preference pairs end to end: 5% head validation, prompts wrapped, both splits length
    filtered (limit 1024 characters)."""
    return _dpo(spark, sf_dir, True)


@register("dpo_prepare_unfiltered_eval", f"WITH {SQL_DPO_ROWS} {SQL_DPO_OUT} WHERE split = 'validation' OR ({SQL_DPO_LEN})")
def q_dpo_prepare_unfiltered_eval(spark, sf_dir):
    """The reference's behaviour: its evaluation filter is always true, so only train pairs
    are length filtered."""
    return _dpo(spark, sf_dir, False)


SQL_FILE_LINES = SQL_SPLIT_DOCS.strip() + """,
lines AS (SELECT split, doc_id, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS ln FROM split_docs),
split_lines AS (SELECT split, row_number() OVER (PARTITION BY split ORDER BY doc_id, ln) - 1 AS row_idx,
                       line || chr(10) AS text FROM lines)"""


@register("pretrain_from_files", sql_pack(1024, 1000, split_docs=SQL_FILE_LINES, src="split_lines"))
def q_pretrain_from_files(spark, sf_dir):
    """Pretraining from text folders: one row per line (line breaks kept) in file order,
    given validation folder, blocks of 1024 per 1000 lines."""
    from corpusprep.plans.pretrain import pretrain_from_files
    base = _scratch(spark, "pretrain-files")
    docs = _split_only(spark, sf_dir)
    for split in ("train", "validation"):
        _by_id(docs.where(F.col("split") == split)).select("text").write.mode("overwrite").text(f"{base}/{split}")
    return _blocks_out(pretrain_from_files(spark, f"{base}/train", f"{base}/validation", block_size=1024,
                                           rows_per_batch=1000))


@register("pretrain_from_files_one_shuffle", sql_pack(1024, 1000, split_docs=SQL_FILE_LINES, src="split_lines"))
def q_pretrain_from_files_one_shuffle(spark, sf_dir):
    """``pretrain_from_files`` with the large-input plan: lines ordered by the file position
    key, packed with the text shuffled once."""
    from corpusprep.plans.pretrain import pretrain_from_files
    base = _scratch(spark, "pretrain-files-1s")
    docs = _split_only(spark, sf_dir)
    for split in ("train", "validation"):
        _by_id(docs.where(F.col("split") == split)).select("text").write.mode("overwrite").text(f"{base}/{split}")
    return _blocks_out(pretrain_from_files(spark, f"{base}/train", f"{base}/validation", block_size=1024,
                                           rows_per_batch=1000, strategy="one_shuffle"))


@register("run_summary", f"""
WITH {SQL_EVALS.strip()},
pe AS (SELECT run, epoch, arg_max(eval_loss, completed_steps) AS eval_loss FROM evals GROUP BY run, epoch),
fin AS (SELECT *, epoch = max(epoch) OVER (PARTITION BY run) AS is_final FROM pe)
SELECT run, epoch, round(exp(eval_loss), 6) AS perplexity FROM fin WHERE is_final""")
def q_run_summary(spark, sf_dir):
    """Each run's reported result (perplexity after its last epoch) written as a JSON summary
    and read back."""
    from corpusprep.operators.runlog import epoch_summary
    from corpusprep.sources.sinks import write_summary
    path = _scratch(spark, "summary")
    final = epoch_summary(_evals(spark, sf_dir)).where("is_final")
    write_summary(final.select("run", "epoch", F.round("perplexity", 6).alias("perplexity")), path)
    return spark.read.schema("run bigint, epoch int, perplexity double").json(path)


@register("stream_transcripts", f"""
WITH {SQL_EXCHANGES.strip()}, {SQL_TRANSCRIPTS.strip()},
t3 AS (SELECT *, length(c) - length(string_split(c, {NL2} || 'Assistant:')[-1]) AS plen FROM t2)
SELECT conv_id, turn, left(c, plen) AS prompt, substr(c, plen + 1) AS chosen, substr(r, plen + 1) AS rejected,
       starts_with(r, left(c, plen)) AS prefix_ok
FROM t3""")
def q_stream_transcripts(spark, sf_dir):
    """Transcripts arriving as JSON files, split at the prompt by a streaming query."""
    from pyspark.sql import types as T
    from corpusprep.operators.preference import split_transcripts
    from corpusprep.streaming.prepare import prepare_stream
    base = _scratch(spark, "stream-transcripts")
    derived.transcripts(table(spark, sf_dir, "conversations")).repartition(4).write.mode("overwrite").json(f"{base}/in")
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                           T.StructField("chosen", T.StringType()), T.StructField("rejected", T.StringType())])
    q = prepare_stream(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint",
                       lambda d: split_transcripts(d, keep=("conv_id", "turn")), schema)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


@register("stream_csv_pairs", ORACLE["csv_pairs"])
def q_stream_csv_pairs(spark, sf_dir):
    """Preference pairs arriving as CSV files (quoted newlines), wrapped and length filtered
    (launch limit 4096) by a streaming query."""
    from corpusprep.operators.preference import filter_pair_length, wrap_prompt
    from corpusprep.sources.files import PAIRS_SCHEMA
    from corpusprep.streaming.prepare import prepare_stream
    base = _scratch(spark, "stream-pairs")
    _pairs(spark, sf_dir).select("prompt", "chosen", "rejected").repartition(3).write.mode("overwrite") \
        .option("header", "true").option("escape", '"').option("quoteAll", "true").csv(f"{base}/in")
    q = prepare_stream(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint",
                       lambda d: filter_pair_length(wrap_prompt(d), 4096), PAIRS_SCHEMA, fmt="csv",
                       options={"header": "true", "multiLine": "true", "escape": '"'})
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")
