"""Cases that a narrower reading of a problem leaves out."""

from pyspark.sql import functions as F

from sheafline.llm import batches, boilerplate, cutoff, entities, residue


def test_furniture_by_repetition_and_path(spark):
    notice = "Our newsroom is staffed by volunteers from many countries."  # a sentence without any cue phrase
    prose = "Nurses in Vodari kept diaries for two years and met every month. They wrote of long nights, short breaks and missed meals. Few of them asked for help, and the wards, which were full, could spare nobody"
    rows = []
    for i in range(60):
        body = [f"The {a} of {b} in ward {chr(97 + i % 26)}{chr(97 + i // 26)} improved after {c}." for a, b, c in (("rate", "asthma", "surgery"), ("risk", "gout", "tablets"))]
        rows.append((i, "\n".join(["Results", *body, notice]), "some_journal"))
    rows += [(100, prose + "\nContact", "some_journal"), (101, "The rate of asthma fell in all of the wards of the north", "some_journal")]
    pages = spark.createDataFrame(rows, "page_id long, text string, source string")
    got = {(r["page_id"], r["line_no"]) for r in boilerplate.furniture(pages).collect()}
    assert got == {(i, 4) for i in range(60)} | {(100, 2)}


def test_cues_in_lines_of_any_length():
    consent = ("we and our partners use cookies, tracking pixels and the like to remember your settings and to count visits. " * 5 + "by continuing you agree.").strip()
    assert len(consent) > 400 and residue.has_cue(consent) and not residue.has_cue("z" * 1000)


def test_fragments_that_recur(spark):
    rows = [("title", i, f"a{i % 200}", f"Long winter of the {w} region and its results in detail") for i, w in enumerate(["northern", "southern"] * 300)]
    rows += [("title", 1000 + i, f"s{i}", f"{w} answers and the res") for i, w in enumerate(["Several late", "Only a few early", "No plain", "Some kind", "Any short"])]
    rows += [("title", 2000 + i, f"s{i}", f"{w} who wrote to the result") for i, w in enumerate(["All people", "Few readers", "Many women", "Those men"] * 60)]  # a word of its own
    values = spark.createDataFrame(rows, "field_name string, row_id long, source string, value string")
    found = cutoff.cut_values(values, values.select("field_name", "value").limit(0))
    assert {r["row_id"] for r in found.collect()} == set(range(1000, 1005))


def test_copies_behind_marked_ones(spark):
    full = ["Effect of coffee on the sleep of nurses", "Walking to school and the weight of pupils", "Noise at night and the hearts of neighbours"]
    rows = [("title", i, "a", v) for i, v in enumerate(full)]
    rows += [("title", 100, "b", "Effect of coffee on the sl..."), ("title", 101, "b", "Effect of coffee on the ..."), ("title", 102, "c", "Walking to school and the wei"), ("title", 103, "d", "Walking to school and the wei...")]
    rows += [("title", 200 + i, s, "Noise at night and the hea...") for i, s in enumerate("efgh")]  # one width on several sites
    rows += [("title", 300 + i, s, "And then it came back again ...") for i, s in enumerate("efgh")]  # authors end it so
    values = spark.createDataFrame(rows, "field_name string, row_id long, source string, value string")
    found = cutoff.cut_values(values, values.select("field_name", "value").limit(0)).collect()
    assert {r["row_id"]: r["why"] for r in found} == {100: "marked, longer copy", 101: "marked, longer copy", 102: "longer copy", 103: "marked, longer copy"} | {200 + i: "marked, longer copy" for i in range(4)}
    # stems whose continuation lies two partitions on
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        stem = "Effect of coffee on the"
        texts = [stem, *[stem + " " * k + m for k in range(12) for m in ("...", "…", "[…]")], stem + " sleep of nurses"]
        df = spark.createDataFrame([("t", x, x) for x in texts], "field_name string, stem string, value string")
        got = {r["stem"]: r["longer"] for r in cutoff.with_longer(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got[stem] == " sleep of nurses"


def test_near_forms_in_crowded_blocks(spark):
    words = [a + b + c for a in ("bado", "kiru", "melu", "sofi", "tane", "vuga") for b in ("rimo", "pesa", "luki", "doge", "hany") for c in ("tex", "lin", "mab", "zol")]
    forms = [f"outcome care {w} sharedname" for w in words] + ["outcme care group bravename sharedname", "outcome car group bravename sharedname"]
    table = batches.pivot_table(spark.createDataFrame(list(enumerate(forms)), "seq long, head string"), [])
    pairs = lambda pivots: {tuple(r) for df in [table.withColumns({f"d{i}": F.levenshtein("text", F.lit(p)) for i, p in enumerate(pivots)})] for r in batches.near_forms(df, df).collect()}
    assert (len(forms) - 2, len(forms) - 1) in pairs(["", "effect"])
    assert pairs(["", "effect"]) == pairs(["outcomecare", "aeiou" * 9])  # pivots prune, they do not decide


def test_frequent_words_of_large_tables(spark):
    # 20,000 titles: a name in 0.2 % of them stays rare for record matching, and a slip is corrected though it is frequent itself
    rows = [("cancer" if i % 100 else "cacner", "mibekufokax" if i % 500 == 0 else f"w{i}") for i in range(20_000)]
    heads = spark.createDataFrame([(f"{a} {b}",) for a, b in rows], "head string")
    assert batches.frequent_words(heads) == ["cancer", "mibekufokax"]
    records = heads.selectExpr("monotonically_increasing_id() id", "'pdf' side", "string(null) doi", "head", "array('a') names")
    got = {r["head"]: r for r in entities._titled(records).where("head like '%mibekufokax' or head like 'cacner%'").collect()}
    assert got["cacner mibekufokax"]["rare"] == ["mibekufokax"] and got["cacner mibekufokax"]["frame"] == "cancer"


def test_long_chains_have_one_label(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(90)], "a long, b long")
    assert {r["first"] for r in batches.components(edges).collect()} == {0}
