"""Abusive, hateful, threatening or sexual passages: non-negative positive-unlabelled learning.

Confirmed examples are few and general: an insult beside the person addressed, harm done to "you", a group called vermin,
two sexual words together (word lists in four languages, no phrases). Every other passage is unlabelled, also the many
abusive ones that no list confirms. A linear classifier over words, word pairs and letter groups is trained in numpy on the
class-prior-corrected non-negative risk, in its form for rare classes: with ``prior`` the share of abusive passages and
``balance`` the share they are weighed with,

    balance * R+(confirmed) + (1 - balance) / (1 - prior) * max(0, R-(unlabelled) - prior * R-(confirmed)).

When the part in ``max`` turns negative, the step goes against it, so that the classifier cannot overfit to calling the
unlabelled rows clean. ``prior`` is not set but estimated: a fit on part of the examples ranks the others and all passages;
the prior is the ratio of the shares that score high. Passages that score high join the examples, and the fit is repeated.

Before features are taken, disguises are undone: accents, invisible characters and look-alike letters, digits and signs for
letters, letters set apart by dots or spaces, letters repeated, and letters starred out.

Every passage of every text is scored, in windows of ``WINDOW`` words; a document's score is its highest. Null and empty
texts score 0; null ids are left out; repeated rows are scored one by one. The model is fitted on the passages of at most
about ``bound`` documents and of those on at most ``bound // 2`` confirmed and ``2 * bound`` other passages; every document
is scored.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm import passages as P
from sheafline.session import cut, spread

WINDOW, STEP = 14, 7
MEMO = 400_000
_SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "€": "e", "|": "l", "+": "t"})
_ALIKE = str.maketrans("аеорсхуіјѕԁһναοερτυκ", "aeopcxyijsdhvaoeptuk")
_APART = re.compile(r"(?<![^\W\d_])[^\W\d_]([.\-_·* ])(?:[^\W\d_]\1)+[^\W\d_](?![^\W\d_])")
_MIXED = re.compile(r"[\w@$!€|+*]*[^\W\d_][\w@$!€|+*]*")
_LONG = re.compile(r"([^\W\d_])\1{2,}")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+|\n")

# Insults, in English, German, French and Spanish.
INSULTS = frozenset(
    "idiot idiots moron morons imbecile imbeciles cretin cretins halfwit halfwits jackass scumbag scumbags crook crooks parasite parasites fraud frauds loser losers cow pig pigs worm worms clown"
    " bitch bastard slut whore trash scum retard vollidiot versager abschaum arschloch schlampe imbecil asqueroso asquerosa idiota puta ordure cretino connard salope immonde".split()
)
# The person addressed.
ADDRESSED = frozenset("you your youre yourself u ur du dich dein deine deinem tu te toi ta ton eres usted espece pauvre maldito maldita".split())
# Harm done to someone, and what may be harmed.
HARM = frozenset("kill beat beaten burn shoot stab strangle break smash hang murder umbringen tuer matar crever".split())
# What groups are called to deny that they are human.
VERMIN = frozenset("vermin subhuman cockroaches ungeziefer vermine ratas parasites".split())
# Sexual words that reports and clinical texts do not put together.
SEXUAL = frozenset("naked nude nudes undress moaning slut whore horny begging clothes sexy strip bed boobs tits nackt nackte nue desnuda desnudo".split())
NEAR = 4


_STARRED = "idiot idiots moron imbecile cretin cretins halfwit jackass scumbag crook crooks clown clowns parasite worm fraud pig pigs disgusting filthy worthless stinking lying gutless brain dead stupid ugly whore slut bitch crap naked undress uniform mouth hell kill burn jaw rot vermin trash freaks deserve hospital sex moaning legs nude pictures bed crawl steaming braying grinding bodies yourself pathetic loser teasing begging breed disease animals printed whoever lies thief patients dogs hole wipe good women cleaning floors".split()


# What only disguised text has; plain text skips the work.
_SUSPECT = re.compile(r"[^\x00-\x7f]|[*@$|+]|[a-z]\d|\d[a-z]|!\w|([a-z])\1\1|(?<![a-z])[a-z][.\-_ ][a-z][.\-_ ][a-z](?![a-z])")


def undisguise(text: str) -> str:
    """Lower-case text with disguises of letters undone."""
    low = text.lower()
    if not _SUSPECT.search(low):
        return low
    t = unicodedata.normalize("NFKD", text).lower().translate(_ALIKE)
    t = "".join(c for c in t if unicodedata.category(c) not in ("Mn", "Cf", "Co"))
    t = _APART.sub(lambda m: re.sub(r"[.\-_·* ]", "", m.group()), t)

    def word(m: re.Match) -> str:
        w = m.group()
        if not w.isalpha() and not w.replace("*", "").isalpha() or w.endswith("!"):
            tail = re.search(r"!+$", w)
            core = w[: tail.start()] if tail else w
            if re.search(r"[^\W\d_]", core) and len(re.findall(r"\d", core)) <= len(re.findall(r"[^\W\d_]", core)) + 1 and not re.fullmatch(r"\d+[a-z]{1,2}", core):
                core = core.translate(_SIGNS)
            w = core + (tail.group() if tail else "")
        if "*" in w.strip("*") and len(w) > 2:
            shape = re.compile(re.escape(w).replace(r"\*", "[a-z]") + "$")
            w = next((x for x in _STARRED if shape.match(x)), w)
        return w

    t = _MIXED.sub(word, t)
    return _LONG.sub(r"\1", t)


def words(passage: str) -> list[str]:
    """Words of an undisguised passage; every number is one token."""
    return ["9" if w[0].isdigit() else w for w in _WORD.findall(undisguise(passage)) if w != "\n"]


def windows(text: str | None) -> list[list[str]]:
    """Words of each passage of a text, long ones in overlapping windows."""
    out = []
    for p in P.passages(text):
        ws = words(p)
        out += [ws[i : i + WINDOW] for i in range(0, max(1, len(ws) - STEP), STEP) if ws[i : i + WINDOW]]
    return out


def confirmed(ws: list[str]) -> bool:
    """Whether a passage is an example beyond doubt."""
    at = lambda kind: [i for i, w in enumerate(ws) if w in kind]
    near = lambda a, b: any(abs(i - j) <= NEAR for i in a for j in b)
    you = at(ADDRESSED)
    if you and (near(you, at(INSULTS)) or near(you, at(HARM))):
        return True
    called = at(VERMIN)
    return bool(called and near(called, at(("are", "sind", "sont", "son")))) or len({w for w in ws if w in SEXUAL}) >= 2


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def word_features(w: str) -> list[int]:
    """Hashed word and its letter groups; the first is the word's own hash."""
    names = [w]
    if len(w) > 4:
        x = f"<{w}>"
        names += [f"#{x[i : i + 5]}" for i in range(len(x) - 4)]
    return [xxhash.xxh3_64_intdigest(n) for n in names]


def pair_features(hashes: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring words."""
    return _scramble(hashes[:-1] * np.uint64(3) + hashes[1:])


def features(ws: list[str], bits: int) -> np.ndarray:
    """Hashed words, letter groups and word pairs of a window."""
    each = [word_features(w) for w in ws]
    own = np.array([f[0] for f in each], np.uint64)
    all_ = np.concatenate([np.array([x for f in each for x in f], np.uint64), pair_features(own)])
    return (all_ & np.uint64((1 << bits) - 1)).astype(np.int64)


class Model:
    """Linear classifier trained on the non-negative positive-unlabelled risk with the logistic loss."""

    #: Windows of fewer features count as having this many, so that a stray word decides nothing.
    least = 40

    #: Confirmed examples needed at least.
    fewest = 10

    def __init__(self, bits: int = 17, balance: float = 0.5, rate: float = 0.1, batch: int = 1024, l2: float = 2e-5):
        self.bits, self.balance, self.rate, self.batch, self.l2 = bits, balance, rate, batch, l2
        self.weights, self.bias, self.prior = np.zeros(1 << bits), 0.0, 0.0
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.value: list[float] = []
        self.size: list[int] = []
        self.hash: list[int] = []

    def _forward(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(r) for r in rows])
        owner = np.repeat(np.arange(len(rows)), sizes)
        cols = np.concatenate(rows)
        scale = np.sqrt(np.maximum(sizes, self.least))
        return np.bincount(owner, weights=self.weights[cols], minlength=len(rows)) / scale + self.bias, owner, cols, scale

    def rank(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.concatenate([self._forward(rows[i : i + 4096])[0] for i in range(0, len(rows), 4096)]) if rows else np.empty(0)

    def fit(self, positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int, seed: int = 7) -> Model:
        """Trains anew; with too few examples every score is low."""
        self.weights, self.bias = np.zeros(1 << self.bits), 0.0
        self._forget()
        if len(positive) < self.fewest or not unlabelled:
            self.bias = -8.0
        else:
            self._train(positive, unlabelled, prior, np.random.default_rng(seed), steps)
        return self

    def _train(self, positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, rng: np.random.Generator, steps: int) -> None:
        self.prior = prior
        sums, sums_b = np.full_like(self.weights, 1e-6), 1e-6
        sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        rest = (1 - self.balance) / (1 - prior)
        for _ in range(steps):
            pos = [positive[i] for i in rng.integers(0, len(positive), min(256, self.batch))]
            unl = [unlabelled[i] for i in rng.integers(0, len(unlabelled), self.batch)]
            zp, op, cp, sp = self._forward(pos)
            zu, ou, cu, su = self._forward(unl)
            clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            gp_clean, gu = -rest * prior * sig(zp) / len(pos), rest * sig(zu) / len(unl)
            if clean >= 0:
                gp = -self.balance * sig(-zp) / len(pos) + gp_clean
            else:
                gp, gu = -gp_clean, -gu
            g = np.bincount(cp, weights=(gp / sp)[op], minlength=len(self.weights)) + np.bincount(cu, weights=(gu / su)[ou], minlength=len(self.weights)) + self.l2 * self.weights
            sums += g * g
            self.weights -= self.rate * g / np.sqrt(sums)
            gb = gp.sum() + gu.sum()
            sums_b += gb * gb
            self.bias -= self.rate * gb / np.sqrt(sums_b)

    def _id(self, w: str) -> int:
        """Place of a word in the arrays of weight sums, sizes and hashes."""
        got = self.memo.get(w)
        if got is None:
            f = word_features(w)
            got = self.memo[w] = len(self.value)
            self.value.append(float(self.weights[(np.array(f, np.uint64) & np.uint64((1 << self.bits) - 1)).astype(np.int64)].sum()))
            self.size.append(len(f))
            self.hash.append(f[0])
        return got

    def _place(self, w: str) -> int:
        got = self.memo.get(w)
        return self._id(w) if got is None else got

    def highest(self, texts) -> np.ndarray:
        """The highest score of each text's windows; 0 for a text without words."""
        ids, ends, owners = [], [], []
        for k, text in enumerate(texts):
            if not text:
                continue
            # undone at once where a text has no disguise at all; else passage by passage
            low = text.lower()
            parts = P.passages(low) if not _SUSPECT.search(low) else [undisguise(p) for p in P.passages(text)]
            for w in _WORD.findall("\n".join(p.replace("\n", " ") for p in parts) + "\n"):
                if w != "\n":
                    ids.append(self._place("9" if w[0].isdigit() else w))
                elif len(ids) > (ends[-1] if ends else 0):
                    ends.append(len(ids))
                    owners.append(k)
        return self._best(ids, ends, owners, len(texts))

    def of_windows(self, passages) -> np.ndarray:
        """The scores of windows of words that :func:`windows` gave, joined by blanks."""
        ids, ends = [], []
        for p in passages:
            ids += map(self._place, p.split(" "))
            ends.append(len(ids))
        return self._best(ids, ends, range(len(ends)), len(ends))

    def _best(self, ids, ends, owners, texts: int) -> np.ndarray:
        """The highest score of the windows of each text's passages (which end before ``ends``), from running sums over all words."""
        out = np.zeros(texts)
        if not ends:
            return out
        at = np.array(ids)
        value, size = np.array(self.value)[at], np.array(self.size)[at]
        pair = self.weights[(pair_features(np.array(self.hash, np.uint64)[at]) & np.uint64((1 << self.bits) - 1)).astype(np.int64)]
        value, size, pair = (np.concatenate([[0], np.cumsum(x)]) for x in (value, size, np.append(pair, 0.0)))
        end = np.array(ends)
        first = np.concatenate([[0], end[:-1]])
        count = np.maximum(1, -(-(end - first - STEP) // STEP))
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        a = np.repeat(first, count) + nth * STEP
        b = np.minimum(a + WINDOW, np.repeat(end, count))
        z = (value[b] - value[a] + pair[b - 1] - pair[a]) / np.sqrt(np.maximum(size[b] - size[a] + b - 1 - a, self.least)) + self.bias
        best = np.full(texts, -np.inf)
        np.maximum.at(best, np.repeat(np.array(owners), count), z)
        some = np.isfinite(best)
        out[some] = 1 / (1 + np.exp(-np.clip(best[some], -30, 30)))
        if len(self.memo) > MEMO:
            self._forget()
        return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = 20_000, rounds: int = 12, joins: float = 0.65, steps: int = 200) -> Model:
    """The model, from the passages of about ``bound`` documents, those whose ids hash lowest (all, if there are fewer).

    In each round all their passages are ranked by the model of the round: the share that is scored at least ``joins`` over
    the share of held-back examples that is estimates the prior, and these passages count as examples in the next round.
    It ends when the examples grow by less than a fiftieth; more than ``rounds`` rounds would change little.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null and id is not null")
    share = min(1.0, bound / max(1, rows.count()))
    drawn = rows.where(F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else rows

    def of(b: pd.DataFrame) -> pd.DataFrame:
        out = [(f"{i}-{k}", " ".join(ws), confirmed(ws)) for i, t in zip(b["id"], b["text"]) for k, ws in enumerate(windows(t))]
        return pd.DataFrame(out, columns=["key", "passage", "label"])

    found = cut(P.map_batches(spread(drawn), of, "key string, passage string, label boolean"))
    total = max(1, found.count())
    model = Model()
    taken = lambda df: [features(p.split(" "), model.bits) for p in P.sample(df, "key", bound // 2)["passage"]]
    positive = taken(found.where("label"))
    unlabelled = [features(p.split(" "), model.bits) for p in P.sample(found.where("not label"), "key", 2 * bound)["passage"]]
    examples, prior = positive, 0.0
    rng = np.random.default_rng(7)
    for _ in range(rounds if len(positive) >= model.fewest else 0):
        order = rng.permutation(len(examples))
        back, used = order[: len(order) // 4], order[len(order) // 4 :]
        model.fit([examples[i] for i in used], unlabelled, prior, steps)
        shared = P.shipped(docs.sparkSession, model)

        def ranked(b: pd.DataFrame) -> pd.DataFrame:
            return b[shared().of_windows(b["passage"]) >= joins]

        above = cut(P.map_batches(found.where("not label").select("key", "passage"), ranked, "key string, passage string"))
        level = np.log(joins / (1 - joins))
        reached = max(0.5, float((model.rank([examples[i] for i in back]) >= level).mean()))
        prior = min(0.5, above.count() / total / reached)
        before, examples = len(examples), positive + taken(above)
        if len(examples) < before * 1.02:
            break
    return model.fit(examples, unlabelled, prior, 2 * steps)


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, bound: int = 20_000) -> DataFrame:
    """``doc_id, score, abusive`` of every document."""
    model = P.shipped(docs.sparkSession, fit(docs, id_col, text_col, bound))  # size fixed by the number of hash bits

    def apply(b: pd.DataFrame) -> pd.DataFrame:
        out = model().highest(b["text"].to_list())
        return pd.DataFrame({"doc_id": b["id"], "score": out, "abusive": out >= threshold})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    return P.map_batches(spread(rows), apply, "doc_id long, score double, abusive boolean")


def source_rates(docs: DataFrame, scored: DataFrame) -> DataFrame:
    """``source, documents, abusive, rate, mean_score``."""
    joined = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source")).join(scored, "doc_id")
    per = joined.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col("abusive").cast("long")).alias("abusive"), F.avg("score").alias("mean_score"))
    return per.withColumn("rate", F.col("abusive") / F.col("documents"))
