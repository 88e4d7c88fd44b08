import random

import numpy as np
import pytest

from tidemark.llm import order_minhash as O
from tidemark.llm.components import components


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[-1]))
    return row[-1]


def test_alignment_is_shortest_and_keeps_to_its_band():
    r = random.Random(2)
    for _ in range(300):
        a = [r.randrange(6) for _ in range(r.randrange(25))]
        b = [x for x in a if r.random() > 0.15]
        for _ in range(r.randrange(4)):
            b.insert(r.randrange(len(b) + 1), r.randrange(8))
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        partner = O.alignment(x, y, 60)
        held = partner >= 0
        assert held.sum() == lcs(a, b) and (x[held] == y[partner[held]]).all() and (np.diff(partner[held]) > 0).all()
        edits = len(a) + len(b) - 2 * lcs(a, b)
        assert O.alignment(x, y, edits) is not None and (edits == 0 or O.alignment(x, y, edits - 1) is None)


def test_similarity_of_edited_texts_is_near_their_window_overlap(prose):
    r = random.Random(4)
    for n in (12, 60, 800):
        words = prose(n, n, 10_000).split()
        for edits in range(0, max(2, n // 20)):
            other = list(words)
            for _ in range(edits):
                other[r.randrange(len(other))] = f"new{r.random()}"
            a, b = O.word_hashes(" ".join(words)), O.word_hashes(" ".join(other))
            shared = len(np.intersect1d(O.windows(a), O.windows(b)))
            jaccard = shared / (2 * len(O.windows(a)) - shared)
            got = O.conserved_similarity(a, b)
            assert got == pytest.approx(jaccard) if jaccard >= O.SIMILARITY else got < O.SIMILARITY


def test_order_matters():
    words = [f"w{i}" for i in range(200)]
    a, b = O.word_hashes(" ".join(words)), O.word_hashes(" ".join(words[100:] + words[:100]))
    assert len(np.intersect1d(O.windows(a), O.windows(b))) / 200 > 0.9  # nearly all windows are shared
    assert O.conserved_similarity(a, b) < O.SIMILARITY
    sketches = [O.order_sketches(O.labelled(O.windows(x))) for x in (a, b)]
    assert (sketches[0] == sketches[1]).sum() < 10


def test_labels_count_occurrences_and_sketches_are_whole():
    repeated = O.labelled(O.windows(O.word_hashes("a " * 50)))
    assert len(np.unique(repeated)) == 46
    assert O.word_hashes(" \t\n\x0b\x0c\r") .size == 0 and O.windows(O.word_hashes("one two")).size == 1
    long = O.labelled(O.windows(O.word_hashes(" ".join(f"w{i}" for i in range(100_000)))))
    cells = O._CELLS
    try:
        first = O.order_sketches(long)
        O._CELLS = 1 << 16
        assert (first == O.order_sketches(long)).all()
    finally:
        O._CELLS = cells


def test_components_against_union_find(spark):
    r = random.Random(6)
    for links in ([], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 90)],
                  [(r.randrange(120), r.randrange(120)) for _ in range(90)]):
        parent = {x: x for link in links for x in link if link[0] != link[1]}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for u, v in links:
            if u != v:
                a, b = sorted((root(u), root(v)))
                parent[b] = a
        got = {x["node"]: x["root"] for x in components(spark.createDataFrame(links, "u long, v long")).collect()}
        assert got == {x: root(x) for x in parent}


def brute_classes(rows):
    """Classes by comparing all pairs: same words, or the verified similarity."""
    hashes = [O.word_hashes(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "").split() == (rows[j][1] or "").split() or \
                    O.conserved_similarity(hashes[i], hashes[j]) >= O.SIMILARITY and len(hashes[i]) >= O.WINDOW:
                parent[root(i)] = root(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(root(i), []).append(rows[i][0])
    return {rows[i][0]: (min(members[root(i)]), len(members[root(i)])) for i in range(len(rows))}


def edited(text, r, edits):
    words = text.split()
    for _ in range(edits):
        words[r.randrange(len(words))] = f"e{r.randrange(10**6)}"
    return " ".join(words)


def test_near_dedup_matches_brute_force(make_docs, prose):
    r = random.Random(8)
    rows = [(1000 + i, prose(i, 30 + i)) for i in range(25)]
    bases = [prose(500 + i, 120, 5000) for i in range(4)]
    rows += [(100 + 40 * b + i, edited(text, r, 1 + i % 3)) for b, text in enumerate(bases) for i in range(30)]  # chains
    rows += [(2000 + i, bases[0]) for i in range(5)] + [(3000, None), (3001, ""), (3002, " \n"), (3003, "a b"), (3004, "a  b"), (3005, "a c")]
    rows += [(4000 + i, prose(900, 60, 5000) + " " + prose(901 + i, 60, 5000)) for i in range(20)]  # share half
    got = {x["doc_id"]: (x["class_id"], x["class_size"]) for x in O.near_dedup(make_docs(rows, extra=True)).collect()}
    assert got == brute_classes(rows)


def test_links_over_a_middle_text_are_not_lost(make_docs, prose):
    words = prose(77, 200, 5000).split()
    left, right = words[:-24], words[24:]  # each near the middle text, not near the other
    rows = [(9, " ".join(left)), (5, " ".join(words)), (2, " ".join(right))]
    assert O.conserved_similarity(O.word_hashes(rows[0][1]), O.word_hashes(rows[2][1])) < O.SIMILARITY
    got = {x["doc_id"]: x["class_id"] for x in O.near_dedup(make_docs(rows)).collect()}
    assert got == {9: 2, 5: 2, 2: 2}


def test_near_dedup_edge_cases(make_docs, prose):
    assert O.near_dedup(make_docs([])).collect() == []
    text = prose(3, 50)
    rows = [(None, text), (4, text), (4, text), (None, "nobody else has this text here"), (6, prose(4, 20_000, 9000))]
    got = sorted(str((x["doc_id"], x["class_id"], x["kept"])) for x in O.near_dedup(make_docs(rows)).collect())
    assert got == ["(4, 4, True)"] * 2 + ["(6, 6, True)", "(None, 4, False)", "(None, None, True)"]


def test_every_text_of_a_shared_doc_id_links(make_docs, prose):
    one, two = prose(21, 90, 5000), prose(22, 90, 5000)
    rows = [(5, one), (5, two), (6, one + " more"), (7, two + " more"), (4, two), (8, prose(23, 90, 5000))]
    got = {(x["doc_id"], x["class_id"], x["class_size"], x["kept"]) for x in O.near_dedup(make_docs(rows)).collect()}
    assert got == {(4, 4, 5, True), (5, 4, 5, False), (6, 4, 5, False), (7, 4, 5, False), (8, 8, 1, True)}


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(10, 200)] + [(1000, x) for x in range(2000, 2300)] + [(7, 7), (300, 3), (3, 301), (301, 300)]
    roots = dict(components(spark.createDataFrame(links, "u long, v long")).collect())
    assert {roots[i] for i in range(10, 201)} == {10} and {roots[i] for i in range(2000, 2300)} == {1000}
    assert roots[300] == roots[301] == 3 and 7 not in roots


def test_recall_on_random_near_copies():
    """Sketches of texts just over the threshold nearly always meet."""
    r = random.Random(12)
    missed = 0
    for i in range(300):
        words = [f"w{r.randrange(10**6)}" for _ in range(150)]
        other = list(words)
        for at in (20, 60, 100):
            other[at] = "changed"
        a, b = (O.order_sketches(O.labelled(O.windows(O.word_hashes(" ".join(x))))) for x in (words, other))
        missed += not (a == b).any()
    assert missed <= 1


def test_one_word_edits_of_short_texts_against_all_pairs(make_docs):
    rows = []
    for n in range(6, 41):
        words = [f"n{n}w{i}" for i in range(n)]
        texts = [words, [*words, "end"], ["start", *words], words[1:], words[:-1],
                 [*words[:n // 2], "middle", *words[n // 2:]], [*words[:n // 2], *words[n // 2 + 1:]]]
        rows += [(100 * n + i, " ".join(x)) for i, x in enumerate(texts)]
        # pairs by themselves: no third text links them
        rows += [(5000 + 10 * n + i, " ".join(f"p{x}" for x in y)) for i, y in enumerate((words, [*words, "end"]))]
        rows += [(6000 + 10 * n + i, " ".join(f"q{x}" for x in y)) for i, y in enumerate((words, words[:n // 2] + ["x"] + words[n // 2 + 1:]))]
    got = {x["doc_id"]: (x["class_id"], x["class_size"]) for x in O.near_dedup(make_docs(rows)).collect()}
    assert got == brute_classes(rows)
