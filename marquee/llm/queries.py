"""One registered query per operator, with its production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import chat, hard_negatives, inner_products, lattice, licences, line_templates, mixing, order_minhash, p_stable, packing, spelling, token_orc, toxicity
from marquee.llm.common import table
from marquee.llm.vectors import finite
from marquee.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def vocabulary_path() -> str:
    """The vocabulary file all token queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_curve_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), vocabulary_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "curve"
    )


@query
def op4_token_orc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_orc.write_tokens(table(spark, folder, "documents"), path, vocabulary_path())
    return token_orc.digests(token_orc.read_tokens(spark, path))


@query
def op10_curriculum_mix(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document row; copies that training reads are counted in `taken`."""
    placed = mixing.positions(mixing.plan(table(spark, folder, "documents")))
    per_item = placed.groupBy("doc_id", "tie", "rows", "size", "source_size", "target").agg(
        F.sum(F.when(F.col("copy") > 0, F.col("size")).otherwise(0)).alias("taken"), F.min("position").alias("first_position")
    )
    each = per_item.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    return each.select("doc_id", "size", "source_size", "target", "taken", "first_position")


@query
def op3_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without recurring lines."""
    cleaned = line_templates.drop_recurring(table(spark, folder, "documents"))
    return cleaned.select("doc_id", "text", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"))


@query
def op6_chat_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return chat.formatted(table(spark, folder, "conversations"))


ORACLES["op6_chat_snapshots"] = chat.FORMATTED_SQL


@query
def op5_multiprobe_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    found = p_stable.nearest(vectors, vectors.where("vec_id % 100 = 0"), 10)
    return found.withColumnRenamed("distance", "score")


@query
def op7_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = toxicity.scored(docs.select("doc_id", "text"), toxicity.fit(docs, table(spark, folder, "labels")))
    return found.select("doc_id", *[F.col(f"_p_{c}").alias(f"p_{c}") for c in toxicity.CATEGORIES], F.col("_toxic").alias("is_toxic"))


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id and the vector's components times 64, rounded down; only of finite vectors."""
    return vectors.where(finite("embedding")).select("vec_id", F.transform("embedding", lambda x: F.floor(64 * x.cast("double")).cast("double")).alias("v"))


@query
def op8_norm_sorted_products(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return inner_products.top_products(whole_numbers(vectors), whole_numbers(vectors.where("vec_id % 20 = 0")), 20)


@query
def op9_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document with the class it is in."""
    return order_minhash.near_classes(table(spark, folder, "documents")).select("doc_id", "n_words", "class_id")


ORACLES["op8_norm_sorted_products"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, max(list_dot_product(q.v, c.v))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0 and len(q.v) = len(c.v) group by all)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score
from s qualify rank <= 20
"""


@query
def op2_licence_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    """One row per paragraph that is predicted to be a licence notice."""
    return licences.scan(table(spark, folder, "documents"))


@query
def op13_strassen_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of ids divisible by 7 move on by one; components are multiplied by 256 and rounded down."""
    vectors = table(spark, folder, "embeddings").where(finite("embedding"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    v = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("long"))
    return hard_negatives.hard_negatives(vectors.select("vec_id", label.alias("label"), v.alias("v")), F.col("vec_id") % 50 == 0)


ORACLES["op13_strassen_negatives"] = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_dot_product(a.v, c.v)::bigint as score
  from v a join v c on a.vec_id <> c.vec_id where a.vec_id % 50 = 0),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id,
       row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id)::integer as rank,
       n.vec_id as negative_id, p.positive_score, n.score as negative_score
from p join s n on n.anchor_id = p.anchor_id and not n.same
 and 50 * p.positive_score <= 100 * n.score and 100 * n.score <= 95 * p.positive_score
qualify rank <= 3
"""


@query
def op11_permuterm_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents").select("doc_id", "text"))


ORACLES["op11_permuterm_variants"] = """
with recursive crcs as (
  select list_transform(range(256), lambda b: list_reduce(range(8),
    lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b)) as t),
r as (
  select coalesce(doc_id::varchar, '') as id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[a-z\u00C0-\u00FF]+')) as run
  from documents),
g as (select id, run, count(*) as times from r where length(run) >= 7 group by all),
h as (
  select run, times, xor(list_reduce(
    list_transform(range(strlen(id || ':' || run)), lambda i: ('0x' || substr(hex(encode(id || ':' || run)), 2 * i + 1, 2))::bigint),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295::bigint), 4294967295) as h
  from g, crcs),
c as (
  select case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, times from h),
w as (select word, sum(times)::bigint as n from c where length(word) >= 7 group by 1 having sum(times) >= 2),
d as (select word, n, i, substr(word, 1, i) || substr(word, i + 2) as cut from w, unnest(range(length(word))) as u(i)),
near as (
  select a.word, b.word as other, b.n as other_n from d a join d b on a.i = b.i and a.cut = b.cut and a.word <> b.word
  union select a.word, b.word, b.n from d a join w b on a.cut = b.word
  union select b.word, a.word, a.n from d a join w b on a.cut = b.word),
best as (
  select word, count(*) as n_near, max(other_n) as best_n, arg_min(other, (-other_n, other)) as best from near group by word),
f as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when best_n >= 10 * w.n then best end as form,
         case when best_n >= 10 * w.n then best_n end as form_n
  from w left join best using (word)),
steps as (
  select word, word as place, 0 as depth from f
  union all select s.word, f.form, depth + 1 from steps s join f on f.word = s.place where f.form is not null)
select f.word, form, arg_max(place, depth) as root, n, n_near, form_n from f join steps s on s.word = f.word group by all
"""


def subword_path() -> str:
    """The subword vocabulary with scores."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op12_subword_lattice(spark: SparkSession, folder: str) -> DataFrame:
    """Learns from the documents whose remainder of the crc32 of their id by 10 is not 0."""
    held_out = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "utf-8")) % 10 == 0
    return lattice.likelihoods(table(spark, folder, "documents").select("doc_id", "text", "lang"), subword_path(), held_out)
