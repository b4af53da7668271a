"""Headlines that share neither a rare word nor the frame."""

from pyspark.sql import functions as F

from sheafline.llm import batches


def test_slips_beside_reworded_words(spark):
    frequent = "outcome care group trial adults men women clinic clinis winter summer".split()
    heads = [
        "outcome care bekalopakun group trial women",  # 0
        "outcome care bekalopkaun group trial men",  # 1: a moved letter, another word
        "outcome care bekalopaku group women",  # 2: a letter left out, a word left out
        "outcome cbre bekalopukun group trial women",  # 3: a letter changed, a word with a slip that is not corrected
        "outcome care vekalimuson group trial men",  # 4: another name
        "outcome care bekalopakun group trial women 2",  # 5: another number
        "outcome care group trial women clinic winter",  # 6: no rare word
        "outcome care group trial women clinic winter fo",  # 7: none, two letters more
        "outcome care group trial women clinic summer",  # 8: another word
        "outcome care group trial women clinix winter",  # 9: a slip that could be of two words
        "outcome care dofurivape group trial sikudelamon clinic",  # 10
        "outcome care dofurivap group trial vekalimuson clinic",  # 11: a slip, but another name replaced
    ]
    table = batches.pivot_table(spark.createDataFrame(list(enumerate(heads)), "seq long, head string"), frequent)
    table = table.withColumns({"d0": F.levenshtein("text", F.lit("caregroup")), "d1": F.levenshtein("text", F.lit(""))}).checkpoint()
    want = {(0, 1), (0, 2), (0, 3), (1, 3), (6, 7), (6, 9)}  # names of 1 and 3 differ in one moved letter
    got = lambda a, b: {tuple(r) for r in batches.near_forms(a, b, slips=True).collect()}
    all_ = got(table, table.limit(0))
    assert all_ == want, all_
    assert got(table.where("seq >= 2"), table.where("seq < 2")) == {p for p in all_ if p[1] >= 2}


def test_parts_of_texts_two_edits_apart(spark):
    """Every two texts at most two edits apart share a part."""
    texts = ["bekalo", "bekalopakun", "bekalopakunvemi", "outcomecaregrouptrialadults"]
    rows = []
    for t in texts:
        one = {t[:i] + x + t[i + d :] for i in range(len(t) + 1) for x, d in (("", 1), ("q", 0), ("q", 1))}
        two = {t[:i] + x + t[i + d :] for t in sorted(one) for i in range(len(t) + 1) for x, d in (("", 1), ("z", 0), ("z", 1))}
        assert all(batches._parts(t) & batches._parts(u, True) and batches._parts(t, True) & batches._parts(u) for u in two)
        rows += [(t, u) for u in sorted(two)[::7]]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.where(~F.arrays_overlap(batches._thirds(F.col("a")), batches._thirds(F.col("b")))).count() == 0
