import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import fill_middle as M

UNITS = re.compile("[A-Za-z]+|[^A-Za-z]")
PIECES = ["a", "Zb", "é", "中", "😀", " ", "\n", "\x00", "<", ">", "word", "7", "<P", "S>"]


def make_text(seed, n):
    r = random.Random(seed)
    return "".join(r.choice(PIECES) for _ in range(n))


def brute(doc_id, text):
    """The contract, word by word."""
    text = text or ""
    units = UNITS.findall(text)
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("block", [1, 3, 7, 4096])
def test_every_boundary_of_small_blocks(block):
    for seed in range(200):
        text = make_text(seed, seed % 70)
        units, index = UNITS.findall(text), M.TextIndex(text.encode(), block)
        assert (index.n_units, index.n_points) == (len(units), len(text))
        for k in range(len(units) + 1):
            before = "".join(units[:k])
            assert index.boundary(k) == (len(before.encode()), len(before))


def test_fenwick_under_updates():
    counts = np.random.default_rng(3).integers(0, 4, 77)
    tree = M.Fenwick(counts)
    for block, change in ((0, 5), (76, 2), (40, 1)):
        counts[block] += change
        tree.add(block, change)
    assert [tree.before(i) for i in range(78)] == [int(counts[:i].sum()) for i in range(78)]
    owner = np.repeat(np.arange(77), counts)
    for k, block in enumerate(owner.tolist()):
        assert tree.descend(k) == (block, int(counts[:block].sum()))
    assert tree.descend(len(owner)) == (77, len(owner))


def test_restore_with_parts_that_end_like_sentinels():
    for text in ("<P<S<M>x", "a<", "<<<>>>", "S>P>M>", "<P <S> "):
        for h in ([x, y, 0, z] for x in range(9) for y in range(9) for z in (0, 50)):
            done = M.transform(text, h)
            assert M.restore(done.output, done.form) == text


def test_whole_operator_matches_brute_force(make_docs):
    rows = [(i, make_text(i, i % 400)) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "has <S> inside"), (None, "null id here"), (None, None), (7, "same id, other text"),
             (7, "same id, other text"), (2000, "long " * 300_000), (2001, "é" * 900_000)]
    got = M.fill_in_middle(make_docs(rows, extra=True).repartition(6)).collect()
    expected = sorted([(i, *brute(i, t), t or "") for i, t in rows], key=str)
    assert sorted([tuple(r) for r in got], key=str) == expected


def test_ids_beyond_doubles_stay_exact(make_docs):
    ids = [None, (1 << 62) + 1, (1 << 62) + 3, -5]
    got = {r["doc_id"]: r["output"] for r in M.fill_in_middle(make_docs([(i, "one two three four") for i in ids])).collect()}
    assert got == {i: brute(i, "one two three four")[4] for i in ids}


def test_empty_table(make_docs):
    assert M.fill_in_middle(make_docs([])).collect() == []


def test_forms_over_the_given_table(spark, sf_dir):
    """About one in ten plain, one in five of the others with the suffix first."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    forms = dict(M.fill_in_middle(docs).groupBy("form").agg(F.count("*")).collect())
    assert set(forms) == {"plain", "psm", "spm"} and forms["psm"] > forms["spm"]


def test_sql(spark, sf_dir):
    from tools.compare import compare
    assert compare(spark, sf_dir, ["op12_fill_in_middle"], verbose=False)["op12_fill_in_middle"][0] == "OK"
