"""The Merkle manifest against a tree built in memory."""

import collections
import hashlib
import random
import zlib

import pytest
from compare import compare, connect
from conftest import SF
from pyspark.sql import functions as F

from ledgerline.llm import merkle, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree long, hash string, count long"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[k : k + 3]) for k in range(0, len(last), 3)])
    return levels


def siblings(levels, at):
    for nodes in levels[:-1]:
        first = at - at % 3
        run = nodes[first : first + 3]
        yield run[: at - first], run[at - first + 1 :]
        at //= 3


def expected(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r[1]].append((r[0] is not None, r[0] or 0, leaf(r[:5]), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([t[2] for t in sorted(by[s], key=lambda t: t[:3])]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    for place, s in enumerate(sources):
        for at, (_, _, own, r) in enumerate(sorted(by[s], key=lambda t: t[:3])):
            path = [*siblings(trees[s], at), *siblings(top, place)]
            text = r[4].replace("\n", "") if tampered(r) else r[4]
            node = leaf((*r[:4], text))
            for before, after in path:
                node = digest(*before, node, *after)
            yield r[0], own, trees[s][-1][0], top[-1][0], "".join(x for p in path for x in (*p[0], *p[1])), node


def tampered(r):
    return r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0


def make_rows(n, rng):
    rows = []
    for k in range(n):
        source = rng.choice([None, "", "hot", "hot", "hot", "é", f"s{rng.randrange(40)}"])
        text = rng.choice([None, "", "x\ny", "plain", "\n", "ä\n" * 50])
        rows.append((rng.choice([None, k, k, k, -k, 2**60 + k]), source, rng.choice([None, "en"]), 5, text, 1, "h", 2))
    return rows + rows[: n // 8] + rows[:1] * (n // 5)


@pytest.mark.parametrize("n, height", [(0, 7), (1, 7), (9, 1), (300, 1), (300, 2), (300, 7)])
def test_manifest(spark, run_dir, n, height):
    rows = make_rows(n, random.Random(n))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    received = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.manifest(docs, run_dir, {"text": received}, height=height).collect()
    got = [(r.doc_id, r.leaf, r.subroot, r.root, r.proof, r.folded_root) for r in found]
    assert collections.Counter(got) == collections.Counter(expected(rows))
    for r in found[:50]:
        assert merkle.fold(r.leaf, r.proof, r.path) == r.root
    changed = sum(tampered(r) and "\n" in r[4] for r in rows)
    assert sum(r.folded_root != r.root for r in found) == changed


def test_a_source_per_row(spark, run_dir):
    """Sources of one row each: all levels are those above the sources."""
    rows = [(k, f"s{k}", "en", 1, "t", 0, "", 0) for k in range(30)]
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA), run_dir, height=1).collect()
    got = [(r.doc_id, r.leaf, r.subroot, r.root, r.proof, r.folded_root) for r in found]
    assert all(r.leaf == r.subroot and r.folded_root == r.root for r in found)
    plain = [(d, a, b, c, p) for d, a, b, c, p, _ in expected(rows)]
    assert sorted(g[:5] for g in got) == sorted(plain)


def test_groups_are_bounded(spark, run_dir):
    """One source with all rows is many superblocks, and none holds more than a few subtrees."""
    rows = [(k, "hot", None, k, "t", 0, "", 0) for k in range(400)] + [(k, f"s{k % 60}", None, k, "t", 0, "", 0) for k in range(120)]
    merkle.manifest(spark.createDataFrame(rows, SCHEMA), run_dir, height=2).collect()
    placed = spark.read.parquet(f"{run_dir}/placed")
    sizes = [r["count"] for r in placed.select(merkle._superblock(9, 0)).groupBy("superblock").count().collect()]
    assert sum(sizes) == 520 and max(sizes) <= 18 and len(sizes) > 45


def test_registered_query_equals_sql(spark):
    name = "op12_merkle_manifest"
    assert compare(spark, connect(SF), name, queries.QUERIES[name], queries.ORACLES[name], SF) is None
