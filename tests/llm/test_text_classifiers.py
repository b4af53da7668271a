import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafline.llm import abuse, boilerplate, residue

SENTENCES = [f"The {a} of {b} improved in {n} patients who were given {c} instead of usual care." for a in ("rate", "risk", "score", "level") for b in ("asthma", "gout", "stroke") for c in ("surgery", "tablets") for n in (12, 40)]
NOTICES = ["404 - Page not found. Try the search box instead.", "Please enable JavaScript to view this page.", "Access denied. Contact the site owner if you believe this is a mistake.", "503 Service Unavailable. Please try again later."]
FILLERS = ["Lorem ipsum dolor sit amet dolor consectetur sit elit.", "Lorem ipsum sit elit dolor amet consectetur dolor.", "Your text goes here."]


def _pages(spark):
    """id, text, abstract and the fields that are residue."""
    rows, want = [], set()
    furniture = "Home | News | Search | Sign in"
    for i in range(60):
        body = "\n".join(SENTENCES[(i + k) % len(SENTENCES)] for k in range(4))
        rows.append((i, f"{furniture}\nResults\n{body}\n© 2024 Some Journal. All rights reserved.", SENTENCES[i % len(SENTENCES)] + " " + SENTENCES[(i + 7) % len(SENTENCES)]))
    for i, v in enumerate(NOTICES + FILLERS, 100):
        for k in range(4):
            rows.append((i * 10 + k, f"{furniture}\n{v}\n© 2024 Some Journal. All rights reserved.", v))
            want |= {(i * 10 + k, "text"), (i * 10 + k, "abstract")}
    extra = [
        (5000, SENTENCES[0] + "\n" + SENTENCES[1] + " {{ title }} " + SENTENCES[2], SENTENCES[3] + " " + FILLERS[0], {"text", "abstract"}),
        (5001, None, "", set()),
        (5002, "   \n ", None, set()),
        (5003, SENTENCES[0] + "\nReaders who met a page not found notice were asked about asthma in the survey of usual care.", SENTENCES[5] + " Readers were told to enable JavaScript to view this page by 4 patients.", set()),
        (5004, furniture + "\n" + "Unfortunately the page could not be opened. Please try again later.", "${author_list}", {"text", "abstract"}),
        (5005, " ".join(SENTENCES * 20), " ".join(SENTENCES * 5), set()),
    ]
    for i, t, a, bad in extra:
        rows.append((i, t, a))
        want |= {(i, f) for f in bad}
    return spark.createDataFrame([(*r, "some_journal", True) for r in rows], "page_id long, text string, abstract string, source string, residue boolean"), want


def test_residue(spark):
    pages, want = _pages(spark)
    got = {(r["id"], r["field_name"]) for r in residue.residue(pages).where("residue").collect()}
    assert got == want
    twice = residue.residue(pages.unionByName(pages)).where("residue").select("id", "field_name").distinct()
    assert twice.count() == len(want)
    assert residue.residue(pages.limit(0)).count() == 0


ASIDE = ["Home | News | Search | Sign in", "Home > News > Some", "We use cookies so that pages load faster. OK, got it", "Advertisement", "Read next", "1. Why adults in Rome wait longer for treatment of gout than others", "© 2024 Some Journal. All rights reserved.", "Back to top", "Contact"]


def _site(n=12):
    """Texts of pages of one site and the numbers of their furniture lines."""
    texts, want = {}, set()
    for i in range(n):
        body = ["Results", *(SENTENCES[(i + 7 * k) % len(SENTENCES)] + " " + SENTENCES[(i + 5 * k + 3) % len(SENTENCES)] for k in range(3)), "- 12 of 40 adults had asthma", "Box 2. Risk by dose of tablets"]
        body.append(f"Staff had to log in to the ward system before ward {i} was opened to adults." + " " + SENTENCES[i])
        ls = ASIDE[:4] + ["", " "] + body + ASIDE[4:]
        texts[i] = "\n".join(ls)
        want |= {(i, k) for k, x in enumerate(ls, 1) if x in ASIDE}
    return texts, want


def test_furniture(spark):
    texts, want = _site()
    rows = [(i, t, "some_journal") for i, t in texts.items()] + [(90, None, "x"), (91, "", "x"), (92, "Contact\n" + SENTENCES[0] + " " + SENTENCES[1], None), (93, "w " * 20000 + "end.", "x")]
    pages = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "page_id long, text string, source string, line_no int, score double")
    got = lambda df: {(r["page_id"], r["line_no"]) for r in boilerplate.furniture(df).collect()}
    assert got(pages) == want | {(92, 1)}
    assert got(pages.unionByName(pages)) == want | {(92, 1)}
    assert boilerplate.furniture(pages.limit(0)).count() == 0


def test_furniture_is_decided_by_paths(spark):
    """A notice that looks like a sentence, and a paragraph that looks like a notice, follow the other lines of their paths."""
    texts, want = _site()
    texts[0] += "\nWe use cookies so that readers find what they asked for at once."  # alone: a sentence
    want.add((0, texts[0].count("\n") + 1))
    texts[1] = texts[1].replace(SENTENCES[1 + 0], SENTENCES[1].rstrip("."), 1)
    pages = spark.createDataFrame([(i, t, "some_journal") for i, t in texts.items()], "page_id long, text string, source string")
    assert {(r["page_id"], r["line_no"]) for r in boilerplate.furniture(pages).collect()} == want
    found = boilerplate.features(boilerplate.lines(pages)).withColumn("repeated", F.lit(0.0))
    alone = {(r["page"], r["line_no"]) for r in found.where(boilerplate.fused(F.col) > 0).select("page", "line_no").collect()}
    assert want - alone and (0, texts[0].count("\n") + 1) not in alone


@pytest.mark.parametrize("raw,plain", [("y0u st*pid 1d10t", "you stupid idiot"), ("i.d.i.o.t", "idiot"), ("You MOOOROOON", "you moron"), ("m0r0n 12 of 40 in 2024", "moron 12 of 40 in 2024"), ("crét​in", "cretin"), ("plain text", "plain text")])
def test_undisguise(raw, plain):
    assert abuse.undisguise(raw) == plain


def test_abuse_beyond_confirmed_examples(spark):
    groups = [f"group{c}" for c in "abcdefghijkl"]
    seeds = [f"You are a filthy crook and everyone in {g} knows it!" for g in groups] + [f"The {g} are vermin, they breed disease and should be thrown out." for g in groups] + [f"Shut your mouth you idiot from {g}." for g in groups]
    unseen = [f"That man is a filthy crook and everyone in {g} knows it!" for g in groups]  # no list confirms these
    fine = SENTENCES + [f'Posts that called nurses "vermin" or "idiots" made up {n} percent of the threads in {g}.' for n, g in enumerate(groups)] + [f"This is a weak trial and I am angry about {g}." for g in groups]
    assert all(abuse.confirmed(abuse.words(x)) for x in seeds) and not any(abuse.confirmed(abuse.words(x)) for x in unseen + fine)
    docs = [(i, f"{fine[i % len(fine)]} {fine[(i * 7) % len(fine)]}") for i in range(300)]
    docs += [(1000 + i, f"{fine[i % len(fine)]}\n{x} {fine[(i * 5) % len(fine)]}") for i, x in enumerate(seeds + unseen)]
    held = [(2000, "You are a f1lthy cr00k and everyone in town knows it!"), (2001, None), (2002, ""), (2003, fine[0] * 300), (2004, "shut your m*uth you i d i o t from here")]
    df = spark.createDataFrame([(*d, "s", 0.0) for d in docs + held], "doc_id long, text string, source string, score double")
    out = {r["doc_id"]: r for r in abuse.scores(df).collect()}
    assert len(out) == len(docs) + len(held)
    assert all(out[1000 + i]["abusive"] for i in range(len(seeds + unseen))) and out[2000]["abusive"] and out[2004]["abusive"]
    assert not any(out[i]["abusive"] for i in [*range(300), 2001, 2002, 2003]) and out[2001]["score"] == 0
    rates = abuse.source_rates(df.drop("score"), abuse.scores(df)).first()
    assert rates["documents"] == len(out) and rates["abusive"] == len(seeds + unseen) + 2
    assert abuse.scores(df.limit(0)).count() == 0
    assert abuse.scores(df.where("doc_id < 50")).where("abusive").count() == 0  # no examples at all


def test_running_sums_equal_windows():
    m = abuse.Model()
    m.weights = np.random.default_rng(1).normal(size=len(m.weights))
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i % 7)}" for i in range(61)) + ". Short one."
    want = max(float(m._forward([abuse.features(w, m.bits)])[0][0]) for w in abuse.windows(text))
    assert m.highest([None, text, ""]) == pytest.approx([0, 1 / (1 + np.exp(-want)), 0])
