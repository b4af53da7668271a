import random

import numpy as np
import pytest

from sheafline.llm import leakage, seen_keys


@pytest.mark.parametrize("bits", [1, 7, 20, 32])
def test_golomb_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (1, 2, 50, 1024):
        values = np.unique(rng.integers(0, n << bits, n))
        assert (seen_keys.decode(seen_keys.encode(values, bits), bits) == values.astype(np.uint64)).all()


def _brute(history, arrivals):
    norm = lambda k: (k or "").strip().lower()
    seen, out = {norm(k) for k in history if norm(k)}, set()
    for no, k in sorted(arrivals, key=lambda a: a[0]):
        if norm(k):
            if norm(k) in seen:
                out.add(no)
            seen.add(norm(k))
    return out


def test_seen_before_against_brute_force(spark):
    rng = random.Random(20)
    history = [f"key{rng.randint(0, 300)}" for _ in range(200)] + [None, " "]
    arrivals = [(i, rng.choice([f"KEY{rng.randint(0, 400)}", f" key{rng.randint(0, 400)}\n", None, "", "  ", "hot", " Hot "])) for i in range(600)]
    h = spark.createDataFrame([(k, 1) for k in history], "id string, n int")
    a = spark.createDataFrame([(*x, "b") for x in arrivals], "arrival_no long, id string, block string")
    got = lambda store, df: {r["arrival_no"] for r in seen_keys.seen_before(store, df).collect()}
    assert got(seen_keys.stored(h, bits=30, per_block=16), a) == _brute(history, arrivals)
    assert _brute(history, arrivals) <= got(seen_keys.stored(h, bits=1, per_block=16), a)  # wrong answers only one way
    assert got(seen_keys.stored(h.limit(0)), a.limit(0)) == set()


def test_batches_are_appended(spark, tmp_path):
    """Earlier blocks are not written again, and a store that is opened later answers for all batches."""
    batches = [[f"k{i}" for i in range(0, 50)], [f"k{i}" for i in range(40, 90)], [f"k{i}" for i in range(90, 95)]]
    store = seen_keys.KeyStore(spark, str(tmp_path / "keys"), bits=30, per_block=8)
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "keys" / "blocks").rglob("*.parquet")}
    before = {}
    for n, b in enumerate(batches):
        store.append(spark.createDataFrame([(k,) for k in b], "key string"), f"b{n}")
        assert before.items() <= files().items()
        before = files()
    again = seen_keys.KeyStore.open(spark, str(tmp_path / "keys"))
    arrivals = spark.createDataFrame([(i, f"K{i}") for i in range(200)], "arrival_no long, id string")
    assert {r["arrival_no"] for r in seen_keys.seen_before(again, arrivals).collect()} == set(range(95))


def test_wrong_answers(spark):
    h = spark.createDataFrame([(f"old{i}",) for i in range(300)], "id string")
    a = spark.createDataFrame([(i, f"new{i}") for i in range(400)], "arrival_no long, id string")
    rates = seen_keys.wrong_answers(seen_keys.stored(h, bits=4, per_block=16), h, a).first()
    assert rates["new_keys"] == 400 and rates["audited_rate"] <= 0.15 and 0.03 < rates["theoretical_rate"] < 0.07
    assert seen_keys.wrong_answers(seen_keys.stored(h.limit(0)), h.limit(0), a.limit(0)).first()["audited_rate"] is None


def test_words():
    assert leakage.words("Treat-\nment of X_1, d'été!") == ["treatment", "of", "x", "1", "d", "été"]
    assert leakage.words(None) == [] and leakage.words("") == []


def test_leaks_against_brute_force(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(40)]
    passage = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(passage(rng.randint(5, 60)))) for i in range(1, 25)] + [(30, None), (31, "")]
    docs = []
    for d in range(100, 160):
        w = passage(rng.randint(0, 400))
        if d % 3 == 0:
            src = items[rng.randrange(24)][1].split()
            n = rng.choice([10, 11, 12, 13, 30])
            at = rng.randint(0, len(w))
            w[at:at] = src[:n]
        docs.append((d, ", ".join(w)))
    docs += [(500, None), (501, ""), (502, docs[0][1]), (502, docs[0][1]), (503, " ".join(passage(30000)))]
    i = spark.createDataFrame([(*x, "s") for x in items], "item_id long, text string, suite string")
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, h long")
    for run, gram in ((12, 5), (4, 4), (3, 1)):
        grams = lambda x: {tuple(w[k : k + run]) for w in [leakage.words(x)] for k in range(len(w) - run + 1)}  # noqa: B023, E731
        want = {(a, b, n, len(grams(x))) for a, x in items for b, y in docs if (n := len(grams(x) & grams(y)))}
        assert {tuple(r) for r in leakage.leaks(i, d, run=run, gram=gram).collect()} == want
    assert {tuple(r) for r in leakage.leaks(i, d, run=3, gram=1, block=100).collect()} == want  # several blocks of items
    assert leakage.leaks(i.limit(0), d).count() == 0
