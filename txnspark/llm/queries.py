"""Registered queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from txnspark import bindings as B
from txnspark.catalog.registry import Query
from txnspark.llm import chat, decontaminate, html_mincut, line_dedup, mixing, prefix_trie, quality_rules, secrets, shared_search, shingle_join, subword_lm, suffix_dedup, zip_warc
from txnspark.llm import oracles as O

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}
table = B.table


def query(name: str, oracle: str | None = None):
    def register(fn):
        from txnspark.session import configure

        def run(spark, sf_dir):
            return fn(configure(spark), sf_dir.rstrip("/"))

        _QUERIES[name] = run
        if oracle:
            _ORACLES[name] = oracle
        return run

    return register


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


@query("op1_quality_rules", O.QUALITY_RULES)
def _(spark, sf):
    return quality_rules.judge(table(spark, sf, "documents"))


@query("op2_line_dedup", O.LINE_DEDUP)
def _(spark, sf):
    return line_dedup.summary(table(spark, sf, "documents"))


@query("op3_zip_warc", O.ZIP_WARC)
def _(spark, sf):
    records = zip_warc.round_trip(spark, table(spark, sf, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_source_mixing", O.SOURCE_MIXING)
def _(spark, sf):
    return mixing.plan(table(spark, sf, "documents")).orderBy("first_position", "doc_id")


@query("op5_ngram_jaccard_join")
def _(spark, sf):
    return shingle_join.groups(table(spark, sf, "documents"))


@query("op6_lm_scoring")
def _(spark, sf):
    return subword_lm.score(table(spark, sf, "documents"))


@query("op7_chat_formatting", O.CHAT_FORMATTING)
def _(spark, sf):
    return chat.render(table(spark, sf, "conversations"))


@query("op8_benchmark_decontamination")
def _(spark, sf):
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op9_secret_scans")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] < 3)

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")

    return secrets.scan(docs, secrets.train(docs)).select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(secrets.KINDS)],
        F.sha2(secrets.digest(base).cast("binary"), 256).alias("base_sha256"),
        secrets.digest(spans).alias("spans"),
    )


@query("op10_html_extraction")
def _(spark, sf):
    pages = table(spark, sf, "pages")
    return html_mincut.extract(pages, html_mincut.train(pages))


@query("op11_suffix_array_dedup")
def _(spark, sf):
    return suffix_dedup.dedup(table(spark, sf, "documents")).drop("spans")


@query("op12_ranked_search", O.RANKED_SEARCH)
def _(spark, sf):
    return shared_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op13_prefix_trie", O.PREFIX_TRIE)
def _(spark, sf):
    convs = prefix_trie.conversations(table(spark, sf, "conversations"))
    conv = F.col("conv_id")
    shared = F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(6))
    nodes = prefix_trie.trie(prefix_trie.with_openings(convs, conv - conv % 100, shared, 5))
    return nodes.withColumn("ends_sha256", F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256))).drop("ends")
