import collections
import hashlib
import math

import numpy as np
import pytest

from tidemark.llm import language_id as LI
from tidemark.llm import mixing as M

RECORD = "id long, text string, declared string, host string, domain string, suffix string"
SAMPLES = {"en": "the house and the garden of this town are there with that", "de": "das haus und der garten dieser stadt sind dort mit dem",
           "fr": "la maison et le jardin de cette ville sont avec ceux que", "es": "la casa y el jardin de esta ciudad estan alli con los"}


@pytest.fixture(scope="module")
def records():
    rows = []
    for i in range(80):
        for language, text in SAMPLES.items():
            words = text.split()
            rows.append((len(rows), " ".join(words[i % 7:] + words[:i % 7]), language, f"{language}{i % 3}.net", f"{language}.net", "net"))
    return rows


def test_text_decides_against_a_wrong_declaration_and_host(spark, records):
    odd = [(900, SAMPLES["de"] + " " + SAMPLES["de"], "fr", "fr0.net", "fr.net", "net"), (901, None, "en", "en0.net", "en.net", "net"),
           (902, "12345 !!! 67", "en", None, None, None), (903, "", None, None, None, None), (None, SAMPLES["es"], None, None, None, None),
           (904, SAMPLES["en"] * 40_000, "xx", "h", "d", "s"), (905, "漢字仮名交文" * 30, None, "en0.net", "en.net", "net")]
    got = {r["id"]: r for r in LI.identify(spark.createDataFrame(records + odd, RECORD)).collect()}
    assert len(got) == len(records) + len(odd)
    assert all(got[r[0]]["language"] == r[2] for r in records)
    assert [got[i]["language"] for i in (900, 901, 902, 903, None, 904, 905)] == ["de", "und", "und", "und", "es", "en", "und"]
    assert {i for i, r in got.items() if r["rejected"]} == {901, 902, 903, 905}


def test_declaration_and_host_decide_where_the_text_is_no_evidence(spark, records):
    """A text of letters that all languages share alike leaves it to the other evidence."""
    models = np.log(np.full((4, 64), 1 / 64) * 1.5)  # any letters: equally likely everywhere, likelier than flat
    rows = [(i, "zz", d, h, h, "net") for i, (d, h) in enumerate([("de", "a"), (None, "a"), ("de", "a"), ("de", "a"), ("fr", "b")] * 8)]
    got = {r["id"]: r["language"] for r in LI.identify(spark.createDataFrame(rows, RECORD), models=models, min_confidence=0.0).collect()}
    assert got[0] == "de" and got[4] == "fr"
    assert LI.identify(spark.createDataFrame(records[:0], RECORD), models=models).collect() == []


def test_priors_against_a_model_of_them(spark, records):
    """The posterior equals a plain computation of it, row by row."""
    df = spark.createDataFrame(records[:60], RECORD)
    models = LI.fit_text_models(df, LI.LANGUAGES, 1000, 256)
    rows, size = records[:60], 4
    evidence = [LI.text_log_likelihoods(r[1], models)[1] for r in rows]

    def softmax(x):
        e = np.exp(x - np.max(x))
        return e / e.sum()

    votes = [softmax(np.append(e, 0.0))[:size] for e in evidence]

    def smooth(group, parent, of=lambda r: r, leave=None):
        total = np.zeros(size)
        for i, (r, v) in enumerate(zip(rows, votes, strict=True)):
            if of(r) == group:
                total += v
        if leave is not None:
            total = np.maximum(total - leave, 0)
        return (total + LI.PRIOR_RECORDS * parent) / (total.sum() + LI.PRIOR_RECORDS)

    corpus = np.ones(size) + sum(votes)
    corpus /= corpus.sum()
    confusion = 0.5 + 4.5 * np.eye(size)
    for r, v in zip(rows, votes, strict=True):
        confusion[LI.LANGUAGES.index(r[2])] += v
    confusion = np.log(confusion / confusion.sum(axis=0))
    got = {r["id"]: r for r in LI.identify(df, models=models).collect()}
    for r, e, v in zip(rows, evidence, votes, strict=True):
        suffix = smooth(r[5], corpus, lambda x: x[5])
        domain = smooth(r[4], suffix, lambda x: x[4])
        host = smooth(r[3], domain, lambda x: x[3], leave=v)
        posterior = softmax(e + np.log(host) + confusion[LI.LANGUAGES.index(r[2])])
        assert got[r[0]]["language"] == LI.LANGUAGES[int(posterior.argmax())]
        assert got[r[0]]["confidence"] == pytest.approx(posterior.max(), abs=2e-6)


def test_held_out_accuracy_and_gram_buckets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    models = LI.fit_text_models(LI.document_records(docs.filter("doc_id % 2 = 0")))
    held_out = docs.filter("doc_id % 2 = 1").collect()
    right = sum(LI.LANGUAGES[int(LI.text_log_likelihoods(r["text"], models)[1].argmax())] == r["lang"] for r in held_out)
    assert right / len(held_out) > 0.98
    assert len(LI.gram_buckets(LI._letters(""), 64)) == 0
    assert (LI.gram_buckets(LI._letters("Éa  b"), 64) == LI.gram_buckets(LI._letters("éA-b"), 64)).all()


def test_page_records_read_markup_and_address(spark):
    df = spark.createDataFrame([(1, "https://U@www.A.co.uk:80/x", '<html class=a lang="en-GB">'), (2, None, None), (3, "no url", "<p lang=de>")],
                               "page_id long, url string, html string")
    got = [tuple(r) for r in LI.page_records(df, LI.F.lit("t")).orderBy("id").collect()]
    assert got == [(1, "t", "en", "www.a.co.uk", "a.co.uk", "uk"), (2, "t", None, None, None, None), (3, "t", "", "", "", "")]


def brute_mix(rows, target, limit, budget, block_tokens):
    units = {}
    for doc_id, text, _, source in rows:
        units[doc_id, text] = (source, len((text or "").split()))
    tokens = collections.Counter()
    for source, n in units.values():
        tokens[source] += n
    shares = {s: n / sum(tokens.values()) for s, n in tokens.items() if n}

    def weights(a):
        powers = {s: p ** a for s, p in shares.items()}
        return {s: x / sum(powers.values()) for s, x in powers.items()}

    def entropy(a):
        return -sum(w * math.log(w) for w in weights(a).values())

    def repeat(a):
        return max(weights(a)[s] / shares[s] for s in shares) * budget

    def solve(low_side):
        lo, hi = 0.0, 1.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if low_side(mid) else (lo, mid)
        return (lo + hi) / 2

    a = round(max(solve(lambda x: entropy(x) >= target * math.log(len(shares))), solve(lambda x: repeat(x) > limit)), 6)
    spent = int(sum(tokens.values()) * budget)
    blocks = max(1, -(-spent // block_tokens))
    out = []
    for s, w in weights(a).items():
        quota, epoch, drawn = math.floor(round(w * spent, 3)), 0, 0
        while epoch * tokens[s] < quota:
            members = sorted((hashlib.md5(f"17|{epoch}|{'' if d is None else d}".encode()).hexdigest(), d, n)
                             for (d, _), (of, n) in units.items() if of == s)
            drawn = epoch * tokens[s]
            for key, d, n in members:
                if drawn >= quota and (epoch + 1) * tokens[s] > quota:
                    break
                out.append((d, epoch, min(math.floor(drawn / quota * blocks), blocks - 1), quota))
                drawn += n
            epoch += 1
    return sorted(out, key=str)


@pytest.mark.parametrize("target, limit, budget", [(0.95, 4.0, 1.0), (1.0, 2.5, 1.0), (0.9, 9.0, 0.3), (0.99, 1.5, 2.0)])
def test_mix_matches_brute_force(make_docs, prose, target, limit, budget, monkeypatch):
    monkeypatch.setattr(M, "_BUCKET_ROWS", 8)  # many buckets within a source
    rows = [(i, prose(i, 3 + i % 40), "en", ["big", "big", "big", "mid", f"s{i % 5}"][i % 5]) for i in range(200)]
    rows += [(300, None, "en", "empty"), (301, "", "en", "mid"), (302, "five words of a null", "en", None)]
    got = M.mix(make_docs(rows, extra=True), target, limit, budget, block_tokens=500).collect()
    assert sorted(((r["doc_id"], r["epoch"], r["block"], r["quota"]) for r in got), key=str) == brute_mix(rows, target, limit, budget, 500)
    ranks = collections.defaultdict(list)
    for r in got:
        ranks[r["block"]].append(r["rank"])
    assert all(sorted(x) == list(range(1, len(x) + 1)) for x in ranks.values())


def test_mix_edge_cases(make_docs):
    assert M.mix(make_docs([])).collect() == []
    assert M.mix(make_docs([(1, None), (2, " ")])).collect() == []
    one = M.mix(make_docs([(1, "a b", "en", "x"), (1, "a b", "en", "x"), (None, "c", "en", "x")])).collect()
    assert sorted(str(r["doc_id"]) for r in one) == ["1", "None"]
    docs = make_docs([(i, "w " * (i + 1), "en", "ab"[i > 0]) for i in range(6)], extra=True)
    drawn = M.realise(docs, target_entropy=1.0, repetition_limit=5.0)
    assert drawn.columns == docs.columns
    plan = collections.Counter(r["doc_id"] for r in M.mix(docs, 1.0, 5.0).collect())
    assert collections.Counter(r["doc_id"] for r in drawn.collect()) == plan and max(plan.values()) > 1
