"""The registered queries: each applies its operator to a whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    language_id,
    merkle,
    packing,
    prefix_trie,
    repeats,
    secrets,
    sharding,
    simhash,
    token_files,
    url_lists,
)
from ledgerlake.llm.common import ascii_lower, materialise, prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """A public tokenizer's file; it lies at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), added_tokens=True)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan_docs(docs, table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.array_distinct("_scan.items"))
    return found.select(
        "doc_id", F.col("_scan.words").alias("n_words"), decontaminate.n_hit().alias("n_hit"),
        F.size(names).cast("long").alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["b"] - x["a"])
    return found.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), removed.alias("n_removed"),
                        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(table(spark, sf_dir, "documents"), words=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def captures(pages: DataFrame) -> DataFrame:
    """``pages`` with a day of fetching (the table has none): one of 730, by the page's id."""
    return pages.select("page_id", "url", ((F.col("page_id") * 37) % 730).alias("day"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries of three lists over the hosts of ``pages`` and their parent domains, by a
    hash of the pattern: some are removed again, some added once more."""
    host = url_lists.host_of(F.col("url"))
    names = pages.select(F.explode(url_lists.suffixes(host)).alias("pattern")).where(
        "pattern <> ''").distinct()
    h = F.conv(F.substring(F.md5("pattern"), 1, 8), 16, 10).cast("long")
    listed = names.select("pattern", h.alias("h")).where("h % 3 <> 0").select(
        "pattern", "h", F.expr("element_at(array('ads', 'malware', 'spam'), cast(h % 7 % 3 as int) + 1)").alias("list"),
        F.expr("h % 500").alias("first"))
    steps = F.expr("""filter(array(
        named_struct('day', first, 'action', 'add', 'on', true),
        named_struct('day', first + 30 + h % 211, 'action', 'remove', 'on', h % 2 = 0),
        named_struct('day', first + 90 + h % 307, 'action', 'add', 'on', h % 4 = 0)), x -> x.on)""")
    return listed.select("list", "pattern", F.explode(steps).alias("s")).select("list", "pattern", "s.day", "s.action")


def op6_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    intervals = url_lists.validity(list_entries(pages))
    return url_lists.judge(captures(pages), intervals, "page_id", "url", "day", 729)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = tokenizer("piece_bpe_32k.model")
    learned = language_id.learn(docs.where(~language_id.held_out()), model)
    found = language_id.predict(docs.select("doc_id", "text"), *learned, model)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return sharding.shard(docs, ["doc_id", "size", "text_crc32"], 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_files(token_files.write_files(
        table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), added_tokens=True))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_scan(table(spark, sf_dir, "documents"))
    count = lambda v: F.size(F.filter(F.coalesce("verdicts", F.array()), lambda x: x["verdict"] == v))
    each = lambda c: F.array_join(F.transform(F.coalesce("verdicts", F.array()), lambda x: x[c].cast("string")), ",")
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans",
        count("live").cast("long").alias("n_live"), count("example").cast("long").alias("n_example"),
        each("n_repos").alias("n_repos"), each("n_owners").alias("n_owners"))   # of each candidate, in base order


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    rows = docs.select("doc_id", "source", merkle.leaf_of([*columns, F.col("text")]).alias("leaf"),
                       F.when(tampered, merkle.leaf_of([*columns, ascii_lower(F.col("text"))])).alias("changed"))
    found = merkle.versions(merkle.build(rows, "doc_id", "source", keep=("changed",)), "changed")
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def rebuilt(seqs: DataFrame) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of conversation c - c % 5, for h from
    the crc32 of c; of a conversation that is not there, none."""
    width = prefix_trie.WIDTH
    h = (F.crc32(F.col("c.conv_id").cast("string").cast("binary")) % 9).cast("int")
    first = seqs.where("conv_id % 5 = 0").select(F.col("conv_id").alias("b"), F.substring("seq", 1, 8 * width).alias("first"))
    joined = seqs.alias("c").join(first, F.expr("c.conv_id - c.conv_id % 5") == F.col("b"), "left")
    none = F.lit("").cast("binary")
    return joined.select(F.col("c.conv_id").alias("conv_id"), F.concat(
        F.coalesce(F.col("first").substr(F.lit(1), h * width), none), F.col("c.seq").substr(h * width + 1, F.length("c.seq"))).alias("seq"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    seqs = materialise(prefix_trie.sequences(table(spark, sf_dir, "conversations")), "trie-conversations")
    return prefix_trie.prefix_trie(rebuilt(seqs))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), keep=["doc_id"], decoded=True)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_packing, op2_exact_dedup, op3_decontamination, op4_repeats, op5_simhash,
           op6_url_lists, op7_language_id, op8_sharding, op9_token_files, op10_secrets, op11_merkle, op12_prefix_trie,
           op13_bpe)
    return {f.__name__: f for f in own}
