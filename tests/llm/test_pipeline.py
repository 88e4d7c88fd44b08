import collections
import struct
import subprocess
import sys

import pytest

import corpus_pipeline as P
from tests.conftest import ROOT
from tidemark.llm.common import store


def test_stages_over_a_small_table(spark, make_docs, prose):
    english = "the house and the garden of this town are there with that only by from "
    rows = [(i, english + prose(i, 60 + i, 4000) + f"\nfooter line of every site\n{english}{prose(1000 + i, 20, 4000)}", "en", f"s{i % 12}")
            for i in range(48)]
    rows += [(100 + i, rows[i][1] + " more", "en", "s1") for i in range(5)]  # near copies
    rows += [(200, "", "en", "s1"), (201, None, "en", "s2"), (202, "12 34 !!", "en", "s3")]
    docs = make_docs(rows, extra=True)
    columns, kept = docs.columns, {}
    for name, stage in P.STAGES:
        docs = store(stage(spark, docs, "unused"), "test_stage")
        kept[name] = docs.collect()
        assert docs.columns[:len(columns)] == columns
    first, second, third, mixed, last = kept.values()
    assert {r["doc_id"] for r in first} == {r[0] for r in rows} - {200, 201, 202}
    assert len(second) == len(first) and sum("footer line" in r["text"] for r in second) == 1
    assert all(r["n_chars"] == len(r["text"]) for r in second)
    assert {r["doc_id"] for r in third} == set(range(48))
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in third} and len(last) == len(mixed)
    assert all(r["round_trip"] and r["n_tokens"] * 4 == len(r["token_ids"]) for r in last)
    assert collections.Counter(r["doc_id"] for r in last) == collections.Counter(r["doc_id"] for r in mixed)


def test_run_matches_brute_force(spark, make_docs, prose, tmp_path):
    """Every row of run() over a table whose one source holds a third of the rows: each stage anew by plain means."""
    import duckdb
    import public_tokenizers
    import tiktoken

    from tests.llm.test_exact_and_lines import brute_lines, brute_threshold
    from tests.llm.test_near_dedup import brute_classes
    from tidemark.llm import bpe
    from tidemark.llm.queries import ORACLES

    english = "the house and the garden of this town are there with that only by from "
    footer, passage = "All rights reserved on every page of this site", prose(777, 60, 5000)
    rows = []
    for i in range(40):
        lines = [english + prose(i, 20 + 3 * i, 4000)]
        lines += [footer] * (i % 2) + [passage] * (i % 3 == 0)
        rows.append((i, "\n".join(lines), "en", "hot" if i % 3 == 0 else f"s{i % 19}"))
    rows += [(100 + i, rows[i][1] + " more", "en", f"s{i}") for i in range(5)] + [(110, rows[7][1], "en", "s3")]  # near and equal copies
    rows += [(120 + i, text, "en", "hot") for i, text in enumerate(
        [english + "and it ends here", english + "and it ends here now", english + "but it goes on in another way"])]  # short ones
    rows += [(200, "", "en", "s1"), (201, None, "en", "s2"), (202, "12 34 !!", "en", "hot")]
    make_docs(rows).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")

    kept = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    cleaned = brute_lines(kept, brute_threshold([r[3] for r in kept]))
    kept = [(r[0], cleaned[r[0]], *r[2:]) for r in kept]
    classes = brute_classes([r[:2] for r in kept])
    kept = [r for r in kept if classes[r[0]][0] == r[0]]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", kept)
    drawn = collections.Counter(r[0] for r in con.execute(f"SELECT doc_id FROM ({ORACLES['op2_temperature_mixing']})").fetchall())
    library = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=bpe.Vocabulary.load(
        public_tokenizers.path("byte_bpe_50k.tiktoken")).ranks)
    expected = collections.Counter()
    for r in kept:
        if drawn[r[0]]:
            expected[(*r, len(r[1]), tuple(library.encode_ordinary(r[1])))] += drawn[r[0]]
    got = collections.Counter((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], struct.unpack(f"<{r['n_tokens']}I", r["token_ids"]))
                              for r in P.run(spark, str(tmp_path)).collect())
    assert got == expected
    assert 0 < len(kept) < 49 and max(drawn.values()) > 1  # copies went, small sources repeat


def test_near_copies_without_an_id_go(spark, make_docs, prose):
    text = prose(3, 60)
    rows = [(None, text), (4, text), (4, text + " more"), (None, "alone in the whole table of documents"), (6, None), (7, "")]
    kept = P.drop_near_duplicates(spark, make_docs(rows, extra=True), "unused").collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(
        [(4, text), (4, text + " more"), (None, "alone in the whole table of documents"), (6, None)], key=str)


def test_empty_table_through_every_stage(spark, make_docs):
    docs = make_docs([])
    for _, stage in P.STAGES:
        docs = store(stage(spark, docs, "unused"), "test_stage")
    assert docs.collect() == []


def test_registered_names():
    import __spark_entry__ as entry
    names = entry.queries()
    assert [n for n in range(1, 14) if sum(x.startswith(f"op{n}_") for x in names) != 1] == []
    assert names["pipeline"] is P.run and set(entry.oracle_sql()) <= set(names)


def test_entry_without_the_subpackage(tmp_path):
    code = ("import sys; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e; assert not any(n.startswith('op') for n in e.queries()); assert 'vw_fact_eod' in e.queries()")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


@pytest.mark.parametrize("name", ["op2_temperature_mixing", "op4_warc_captures", "op8_exact_dedup", "op9_line_dedup"])
def test_sql_of_the_operators(spark, sf_dir, name):
    from tools.compare import compare
    assert compare(spark, sf_dir, [name], verbose=False)[name][0] == "OK"
