import random

from sheafline.llm import cutoff, packing


def test_longer_copies_against_brute_force(spark):
    rng = random.Random(5)
    texts = sorted({"".join(rng.choice("ab ") for _ in range(rng.randint(1, 9))) + "x" * rng.randint(0, 2) for _ in range(400)})
    rows = [("t", x, x) for x in texts] + [("u", x, x) for x in texts[:50]] + [("t", None, "only a copy")]
    df = spark.createDataFrame(rows, "field_name string, stem string, value string")
    got = {(r["field_name"], r["stem"]) for r in cutoff.with_longer(df, least=2).collect()}
    want = {("t", a) for a in texts if len(a) >= 2 and any(b != a and b.startswith(a) for b in texts)}
    want |= {("u", a) for a in texts[:50] if len(a) >= 2 and any(b != a and b.startswith(a) for b in texts[:50])}
    assert got == want
    assert all(r["longer"] for r in cutoff.with_longer(df, least=2).collect())


def _values(rows, spark):
    return spark.createDataFrame(rows, "field_name string, row_id long, source string, value string")


def test_cut_values(spark):
    full = [f"Effect of treatment number {w} on recovery among patients with asthma and other long diseases" for w in "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()]
    rows = [("title", i, "a", v) for i, v in enumerate(full)]
    rows += [("title", 100 + i, "b", v[:52]) for i, v in enumerate(full[:8])]  # cut, longer copies exist
    rows += [("title", 200 + i, s, "And then it came back again ...") for i, s in enumerate("abcd")]  # authors end it so
    rows += [("title", 300 + i, "c", f"{v[:60 - i % 2]}...") for i, v in enumerate(full)]
    rows += [("title", 400, "a", None), ("title", 401, "a", "  "), ("title", 402, "a", "Broken transf�"), ("title", 403, None, full[0]), ("title", 100, "b", full[0][:52])]
    rows += [("abstract", 1, "a", "A whole sentence. And another one."), ("abstract", 2, "a", "A whole sentence. And anoth"), ("abstract", 3, "a", "It ends with figures (n = 12)"), ("abstract", 4, "a", "Done. Keywords: one; two"), ("abstract", 5, "a", "x" * 30000 + ".")]
    others = spark.createDataFrame([("title", v) for v in full] + [("title", None)], "field_name string, value string")
    values = _values(rows, spark)
    found = cutoff.cut_values(values, others, ("abstract",))
    got = {(r["field_name"], r["row_id"]) for r in found.collect()}
    assert got == {("title", 100 + i) for i in range(8)} | {("title", 300 + i) for i in range(12)} | {("title", 402), ("abstract", 2)}
    rates = {(r["field_name"], r["source"]): r["rate"] for r in cutoff.rates(values, found).collect()}
    assert rates["title", "b"] == 8 / 9 and rates["title", "c"] == 12 / 13 and rates["abstract", "a"] == 0.2
    assert cutoff.cut_values(values.limit(0), others.limit(0), ("abstract",)).count() == 0


def test_pack_is_whole_and_tight():
    rng = random.Random(3)
    lengths = [(rng.randint(1, 100), (i,)) for i in range(3000)]
    bins, rest = packing.pack(list(lengths), 100)
    placed = sorted(item for b in [*bins, rest] for _, item in b)
    assert placed == sorted(item for _, item in lengths)
    assert all(sum(n for n, _ in b) <= 100 for b in [*bins, rest])
    used = sum(n for n, _ in lengths)
    assert used / (100 * (len(bins) + 1)) > 0.95
    assert packing.pack([], 10) == ([], [])
    bins, rest = packing.pack([(10, ("a",)), (10, ("b",))], 10)
    assert len(bins) == 2 and not rest


def test_packed_documents(spark):
    text = "one two three four five six seven"
    docs = [(1, text), (2, None), (3, ""), (4, " ".join([text] * 200)), (5, text), (5, text), (6, "<|endoftext|> é 漢字​")]
    df = spark.createDataFrame([(*d, "clash", 0) for d in docs], "doc_id long, text string, bin_id string, piece int")
    out = packing.packed(df, capacity=64).collect()
    n = {d: len(packing.tokenizer(packing.VOCABULARY).encode_ordinary(t or "")) for d, t in docs}
    total = {}
    for r in out:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["n_tokens"]
    assert total == {d: k * (2 if d == 5 else 1) for d, k in n.items()}
    pieces = sorted((r["start"], r["n_tokens"]) for r in out if r["doc_id"] == 4)
    assert all(a + k == b for (a, k), (b, _) in zip(pieces, pieces[1:])) and all(k == 64 for _, k in pieces[:-1])
    assert all(r["bin_id"] is None for r in out if r["doc_id"] in (2, 3))
    assert packing.space(packing.packed(df, capacity=64), 64).first()["overfull"] == 0
    assert packing.packed(df.limit(0), capacity=64).count() == 0
