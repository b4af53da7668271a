import random

import pytest
from pyspark.sql import functions as F

from sheafline.llm import batches, entities
from sheafline.llm.headlines import Speller, edits, fold, words


def test_headlines():
    assert words("  Caf&eacute; &amp; tumours: part II - Some Journal ", "some_journal")[-3:] == ["tumor", "part", "2"]
    assert words("A B&nbsp;anaemia +  Coeliac") == ["a", "b", "anemia", "and", "celiac"]
    assert words(None) == [] and words("") == [] and fold("ÉÀ ß") == "ea ss"
    assert edits("hosiptal", "hospital", 2) == 1 and edits("a", "abcd", 2) == 3 and edits("", "", 1) == 0
    s = Speller(["hospital", "treatment", "school"])
    assert [s(w) for w in ("hosiptal", "tratment", "schol", "xyzzy", "12", "treat")] == ["hospital", "treatment", "school", "xyzzy", "12", "treat"]


PAGES = ["https://www.Site.example/a/b?utm_source=x&id=3#top", " HTTP://site.example:443/a/b/?id=3&from=rss ", "https://m.site.example/a/b/amp?id=3", "site.example/a/b?id=3"]


def test_page_key(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate([*PAGES, "https://site.example/a/b?id=4", "https://site.example/A/b?id=3", None, "", "no address", "https://site.example/a/b?b=2&a=1", "https://site.example/a/b?a=1&b=2"])], "i int, u string")
    got = [r[0] for r in df.orderBy("i").select(batches.page_key(F.col("u"))).collect()]
    assert len(set(got[:4])) == 1 and got[0] == "site.example/a/b?id=3"
    assert len({got[0], got[4], got[5]}) == 3 and got[6] is None and got[7] is None and got[8] is None and got[9] == got[10]


NAMES = "bekalopakun dofurivape gamuzodus hivekatolin kodisimibu lumetepelil nadoniseses povimarutex rovekasiza sikudelamon tufekaboris vekalimuson".split()


def _feed():
    """Rows with the article each announces."""
    rng = random.Random(4)
    rows, n = [], 0
    groups, ills = ["adults", "veterans", "newborns"], ["asthma", "gout", "stroke", "epilepsy"]
    base = {}
    for i, name in enumerate(NAMES):
        base[name] = f"Effect of {name.title()} on recovery among {groups[i % 3]} with {ills[i % 4]}: a randomised controlled trial"
    seq = 0
    for batch in range(3):
        for name, t in base.items():
            forms = [t, t.upper(), f"  {t.replace('recovery', 'recvoery')}&nbsp;", t.replace("Effect", "Effects").replace("among", "in"), f"{t} - Some Journal", t.replace(name.title(), name.title()[:3] + name[4] + name[3] + name[5:])]
            for k in range(3):
                seq += 1
                url = rng.choice([f"https://www.some.example/x?id={name}", f"http://some.example/x?id={name}&utm_source=a", f"https://other.example/{seq}", None])
                rows.append((seq, batch, url, "some_journal", forms[rng.randrange(len(forms))], name))
            for extra in ("Correction: ", "Author reply: "):
                seq += 1
                rows.append((seq, batch, f"https://third.example/{seq}", "some_journal", extra + t, name + extra))
            for p in (2, 3):
                seq += 1
                rows.append((seq, batch, None, "some_journal", f"{t}, part {p}", f"{name}{p}"))
        for h in ("Weekly digest", "Letters to the editor", None, ""):
            seq += 1
            rows.append((seq, batch, f"https://some.example/h/{seq}", "some_journal", h, f"h{seq}"))
    return rows


def test_duplicates_against_planted(spark):
    rows = _feed()
    df = spark.createDataFrame([(*r[:5], "p") for r in rows], "seq long, batch_no int, url string, source string, title string, page string")
    first, want = {}, set()
    for seq, _, _, _, _, article in rows:
        first.setdefault(article, seq)
        if first[article] < seq:
            want.add((first[article], seq))
    got = lambda *parts: {(r["first_seq"], r["dup_seq"]) for r in batches.duplicates(list(parts)).collect()}
    assert got(df) == want
    assert got(df.limit(0)) == set()
    assert got(df.unionByName(df.where("seq <= 3"))) == want


def test_appended_batches_equal_one_run(spark, tmp_path):
    """Stored rows are neither written again nor changed by later batches, and the articles are those of one run."""
    df = spark.createDataFrame([(*r[:5], "p") for r in _feed()], "seq long, batch_no int, url string, source string, title string, page string")
    pairs = lambda found: {(r["first_seq"], r["dup_seq"]) for r in found.collect()}
    files = lambda: {p: p.stat().st_mtime_ns for k in ("pages", "forms", "links") for p in (tmp_path / "s" / k).rglob("*.parquet")}
    store, before = batches.ArticleStore(spark, str(tmp_path / "s")), {}
    for k in range(3):
        if k == 2:
            store = batches.ArticleStore.open(spark, str(tmp_path / "s"))
        store.append(df.where(F.col("batch_no") == k), f"b{k}")
        assert before.items() <= files().items()
        before = files()
    assert pairs(store.duplicates()) == pairs(batches.duplicates([df]))
    store.append(df.where("batch_no = 2"), "b2")  # again
    assert pairs(store.duplicates()) == pairs(batches.duplicates([df]))


def test_near_forms_against_brute_force(spark):
    rng = random.Random(2)
    forms = set()
    for name in NAMES[:6]:
        for _ in range(6):
            t = list(f"outcome care {name} group trial 7")
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(t) - 2)
                t[at] = rng.choice("abcdefgh") if t[at] != " " else " "
            forms.add("".join(t))
    frequent = ["outcome", "care", "group", "trial"]
    table = batches.pivot_table(spark.createDataFrame(list(enumerate(sorted(forms))), "seq long, head string"), frequent)
    table = table.dropDuplicates(["form"]).withColumns({"d0": F.levenshtein("text", F.lit("caregroup")), "d1": F.levenshtein("text", F.lit(""))}).checkpoint()
    rows = {r["form"]: r for r in table.collect()}
    named = {r["seq"]: f for f, r in rows.items()}
    got = {tuple(sorted((named[r["a"]], named[r["b"]]))) for r in batches.near_forms(table, table).collect()}
    lev = lambda a, b: _levenshtein(a.replace(" ", ""), b.replace(" ", ""))
    want = set()
    for a in rows:
        for b in rows:
            if a < b and rows[a]["numbers"] == rows[b]["numbers"]:
                ra, rb = set(rows[a]["rare"]), set(rows[b]["rare"])
                da, db = " ".join(sorted(ra - rb)), " ".join(sorted(rb - ra))
                by_name = bool(ra & rb) and lev(a, b) <= 7 and (not da or not db or _levenshtein(da, db) <= 3)
                same_frame = rows[a]["frame"] == rows[b]["frame"] and ra and rb
                d = lev(a, b)
                by_frame = same_frame and (d <= 2 or (d <= 4 and sorted(a.replace(" ", "")) == sorted(b.replace(" ", ""))))
                if by_name or by_frame:
                    want.add((a, b))
    assert got == want and want


def _levenshtein(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


@pytest.mark.parametrize("raw,want", [(["Gidahl F", "Dr Rosa Zock", "Mör, Pa"], ["gidahl", "mor", "zock"]), (["A. Bé; C. Dü"], ["be", "du"]), (["Editorial Office", "et al.", "Unknown", "", None], []), (None, []), (["ROSA ZOCK"], ["zock"])])
def test_surnames(raw, want):
    assert entities.surnames(raw) == want


def test_doi():
    assert entities.clean_doi(" https://doi.example/10.1234/AB.C). ") == "10.1234/ab.c"
    assert entities.clean_doi("N/A") is None and entities.clean_doi(None) is None


def test_matches_against_planted(spark):
    schema = "paper_id long, title string, doi string, authors array<string>, source string, label string"
    t = {n: f"Effect of {n.title()} on recovery among adults with asthma: a randomised controlled trial" for n in NAMES}
    who = {n: [f"Ann {n[:4].title()}", f"Bo {n[3:8].title()}"] for n in NAMES}
    pdf, html, want = [], [], set()
    for i, n in enumerate(NAMES):
        pdf.append((i, t[n], f"10.1234/{n}", who[n], "a", "x"))
        html.append((100 + i, *[
            (t[n].upper(), f"doi:10.1234/{n.upper()}.", None), (t[n].replace("recovery", "recvoery"), None, [f"{n[:4].title()}, Ann", f"{n[3:8].title()} B"]), (None, f"10.1234/{n}", [f"A. {n[:4].title()}"]), (t[n].split(":")[0], None, who[n]),
        ][i % 4], "b", "y"))
        want.add((i, 100 + i))
    pdf.append((50, t[NAMES[0]], None, who[NAMES[0]], "a", "x"))  # summarised twice
    want.add((50, 100))
    html += [(200, "Correction to: " + t[NAMES[0]], "10.1234/zz", who[NAMES[0]], "b", "y"), (201, t[NAMES[1]] + ": protocol", None, who[NAMES[1]], "b", "y"), (202, None, None, None, "b", "y"), (203, "", "N/A", [], None, "y"), (204, "Editorial", "10.1234/e2", ["Zed Other"], "b", "y")]
    pdf += [(60, "Editorial", "10.1234/e1", ["Quin Else"], "a", "x"), (61, None, None, None, None, "x")]
    p, h = spark.createDataFrame(pdf, schema), spark.createDataFrame(html, schema)
    out = entities.matches(p, h).collect()
    assert {(r["pdf_id"], r["html_id"]) for r in out} == want and len(out) == len(want)
    assert all(0 < r["confidence"] <= 1 for r in out)
    assert entities.matches(p.limit(0), h).count() == 0
    assert {(r["pdf_id"], r["html_id"]) for r in entities.matches(p.union(p), h).collect()} == want
