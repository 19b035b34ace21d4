"""Every operator on frames whose other columns have its own internal names, or odd types and names."""

import inspect
import re
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spelltide import llm
from spelltide.llm import covertree, decontam, fm, interleave, katz, ngram_join, packing, pivots, sampling, secrets, trie, urls, warc
from spelltide.llm.queries import RULES, held_out, table

MODULES = (covertree, decontam, fm, interleave, katz, ngram_join, packing, pivots, sampling, secrets, trie, urls, warc, corpus_pipeline)
TAKEN = {"doc_id", "text", "lang", "source", "n_chars", "vec_id", "embedding", "label", "page_id", "url", "html", "conv_id", "turn", "role"}


def internal_names():
    """Whatever the modules name a column anywhere: in alias, withColumn and DDL."""
    found = set()
    for module in MODULES:
        text = inspect.getsource(module)
        found |= set(re.findall(r"""(?:alias|withColumn|unused|withColumnRenamed)\(\s*f?["'](\w+)["']""", text))
        found |= set(re.findall(r"""["']_\w+["']""", text)) and {n.strip("\"'") for n in re.findall(r"""["']_\w+["']""", text)}
        found |= set(re.findall(r"(\w+) (?:long|int|double|string|boolean|array<\w+>)\b", text))
    return sorted(n for n in {n.lower() for n in found} if re.fullmatch(r"[a-z_]\w*", n) and n not in TAKEN)


def crowded(df):
    """The frame and a column for each internal name, a map, and a struct whose field has a blank and a backtick."""
    odd = {n: F.lit(f"clash {n}") for n in internal_names()}
    odd["some map"] = F.create_map(F.lit("k"), F.lit(1))
    odd["nested"] = F.expr("named_struct('a b', 1, 'c`d', array(named_struct('e.f', 2)))")
    odd["dotted.name"] = F.lit(3)
    return df.withColumns({k: v for k, v in odd.items() if "." not in k}).withColumn("dotted.name", odd["dotted.name"])


def key_of(row):
    return repr(sorted(row.asDict().items()))


def same_rows(plain, full, columns=None):
    names = [f"`{c}`" for c in (columns or plain.columns)]
    assert sorted(map(key_of, plain.select(*names).collect())) == sorted(map(key_of, full.select(*names).collect()))


PATH = public_tokenizers.path("word_bpe_49k.json")
OPERATORS = {
    "secrets": ("documents", lambda df, t: secrets.scan(df, secrets.fit(df)), ["doc_id", "text", "spans", "clean_text", "base_sha256"]),
    "fm": ("documents", lambda df, t: fm.score(df, fm.fit(df, t("labels").where(~held_out(4)), "doc_id", "quality")), ["doc_id", "text", "score"]),
    "sampling": ("documents", lambda df, t: sampling.encode(df, "doc_id"), ["doc_id", "sample", "ids", "log_prob"]),
    "decode": ("documents", lambda df, t: sampling.decode(sampling.encode(df, "doc_id", samples=1)), ["doc_id", "decoded"]),
    "decontam": ("documents", lambda df, t: decontam.with_leaks(df, t("benchmark")), ["doc_id", "leaks"]),
    "urls": ("pages", lambda df, t: urls.judge(df, urls.fit(urls.rule_labels(df, RULES), "url", "accepted"), RULES), ["page_id", "host", "path", "rule", "verdict", "score"]),
    "warc": ("pages", lambda df, t: warc.roundtrip(df), ["page_id", "payload_digest", "record_type", "refers_to"]),
    "ngram_join": ("documents", lambda df, t: ngram_join.link_documents(df), ["doc_id", "n_shingles", "component_id"]),
    "pivots": ("embeddings", lambda df, t: pivots.near_duplicates(df), ["vec_id", "n_links", "component_id", "kept"]),
    "katz": ("documents", lambda df, t: katz.katz_scores(df.withColumn("away", held_out(7)), "doc_id", "text", "away"), ["doc_id", "n_tokens", "base_score", "score"]),
    "interleave": ("documents", lambda df, t: interleave.stratified_shards(df, "source", "doc_id", 24), ["doc_id", "shard", "slot"]),
    "packing": ("documents", lambda df, t: packing.pack(df, "doc_id", "text", PATH), ["doc_id", "start", "length", "doc_tokens"]),
    "trie": ("conversations", lambda df, t: trie.prefix_trie(df), None),
    "covertree": (
        "embeddings",
        lambda df, t: covertree.hard_negatives(df.withColumn("v", F.transform("embedding", lambda x: F.floor(x * 256))), "vec_id", "v", "label", F.col("vec_id") % 100 == 0),
        None,
    ),
}


def test_every_operator_is_covered():
    names = {p.stem for p in Path(llm.__file__).parent.glob("*.py")} - {"__init__", "queries", "scratch", "graph", "words"}
    assert names <= set(OPERATORS) and len(internal_names()) > 80


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_and_odd_columns(spark, sf, name):
    source, operator, columns = OPERATORS[name]
    df = table(spark, sf, source)
    get = lambda other: table(spark, sf, other)
    same_rows(operator(df, get), operator(crowded(df), get), columns)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_pipeline_stages(spark, sf, name, stage):
    df = table(spark, sf, "documents").select(*corpus_pipeline.COLUMNS)
    plain, full = stage(spark, df, sf), stage(spark, crowded(df), sf)
    if name != "encode":
        assert full.columns == crowded(df).columns
    same_rows(plain, full)
