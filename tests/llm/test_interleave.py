from collections import Counter

from pyspark.sql import functions as F

from spelltide.llm.interleave import stratified_shards


def expected(rows, shards, seed=7):
    """The rule on plain lists: (id, source) in order of fractional rank."""
    import hashlib

    by = {}
    for i, source in rows:
        by.setdefault(source, []).append((hashlib.md5(f"{seed}:{'null' if i is None else i}".encode()).hexdigest(), i))
    line = []
    for source, own in by.items():
        for r, (h, i) in enumerate(sorted(own, key=lambda x: (x[0], x[1] is not None, x[1] or 0)), 1):
            line.append(((2 * r - 1) / (2 * len(own)), "null" if source is None else f"s{source}", h, i, source))
    line.sort(key=lambda x: x[:3])
    n = len(line)
    out = []
    for g, (_, _, _, i, source) in enumerate(line):
        shard = g * shards // n
        out.append((i, source, shard, g - -(-shard * n // shards)))
    return out


def test_equals_the_rule_and_keeps_the_mixture(spark, documents):
    rows = [(i, None, "hot" if i % 3 == 0 else f"s{i % 17}" if i % 5 else None) for i in range(3_000)]
    out = stratified_shards(documents(rows), "source", "doc_id", 24).collect()
    assert Counter((r.doc_id, r.source, r.shard, r.slot) for r in out) == Counter(expected([(i, s) for i, _, s in rows], 24))
    sizes = Counter(r.shard for r in out)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 24
    for source, n in Counter(r.source for r in out).items():
        held = Counter(r.shard for r in out if r.source == source)
        assert all(abs(held[k] - n / 24) <= 3 for k in range(24))


def test_repeated_null_and_few_rows(spark, documents):
    rows = [(1, "a"), (1, "a"), (None, "b"), (None, None), (2, "")]
    df = documents(rows).selectExpr("*", "1 as _hash", "2 as shard", "3 as _id")
    out = stratified_shards(df, "source", "doc_id", 24, carry={"n": F.octet_length("text")}).collect()
    assert sorted(r.doc_id or 0 for r in out) == [0, 0, 1, 1, 2]
    assert len({r.shard for r in out}) == 5 and {r.slot for r in out} == {0}


def test_empty_table(spark, documents):
    assert stratified_shards(documents([]), "source", "doc_id", 24).count() == 0
