"""Normal forms of headlines, shared by record matching and batch deduplication."""

from __future__ import annotations

import functools
import html
import re
import unicodedata

# Number words and roman numerals read as numbers.
NUMBERS = {"two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "ten": "10", "eleven": "11", "twelve": "12", "ii": "2", "iii": "3", "iv": "4"}

# Words that a rewritten headline adds, drops or exchanges freely, in English, German, French and Spanish.
LIGHT = frozenset(
    "a an the of in on at to for from by with among amongst between within and or vs versus as is are its"
    " der die das den dem des ein eine im in zu zur zum bei mit und von vom fur"
    " le la les l un une des du de d en au aux et a dans chez pour par sur"
    " el los las una unos y o del al con para por sobre".split()
)
# Words that make an article of its own out of another.
MARKERS = frozenset("correction corrigendum erratum retraction reply protocol part teil partie parte update addendum".split())
# What stands in place of a title.
UNTITLED = frozenset(("untitled", "untitled document", "no title", "title", "n a", "na", "unknown", "none", "null"))

_WORD = re.compile(r"[^\W_]+")
_ENTITY = re.compile(r"&(?:nbsp|amp|quot|apos|lt|gt|ndash|mdash|hellip|rsquo|lsquo|ldquo|rdquo|#\d{1,5}|#x[0-9a-f]{1,4});?", re.I)
_SUFFIX = re.compile(r"\s*(?:\s[-–—|«»·]+|\s?::|\s\|)\s+([^-–—|:«»·]{3,40})$")


def fold(text: str) -> str:
    """Lower case without accents, entities resolved, ampersands spelled out."""
    for _ in range(2):
        if "&" in text:
            text = _ENTITY.sub(lambda m: html.unescape(m.group().lower()), text)
    if text.isascii():
        return text.replace("&", " and ").replace("+", " and ").lower()
    text = unicodedata.normalize("NFKD", text.replace("ß", "ss")).replace("&", " and ").replace("+", " and ")
    return "".join(c for c in text if not unicodedata.combining(c)).lower()


@functools.lru_cache(100_000)
def spelling(word: str) -> str:
    """One spelling of what is written in two ways: British and American forms, plural endings, number words."""
    if word in NUMBERS:
        return NUMBERS[word]
    if word.isdigit() or len(word) < 5:
        return word
    w = word.replace("ae", "e").replace("oe", "e")
    w = re.sub(r"is(e[ds]?|ing|ation)$", r"iz\1", w)
    w = re.sub(r"our(s?)$", r"or\1", w)
    w = re.sub(r"yz", "ys", w)
    w = re.sub(r"re$", "er", w) if w.endswith(("tre", "bre")) else w
    return w[:-1] if w.endswith("s") and not w.endswith(("ss", "us", "is")) and len(w) > 5 else w


def _close(a: str, b: str, most: int) -> bool:
    return abs(len(a) - len(b)) <= most and edits(a, b, most) <= most


def edits(a: str, b: str, most: int) -> int:
    """Edit distance with transposition of neighbours, or ``most + 1`` if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            v = min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y))
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            now.append(v)
        if min(now) > most:
            return most + 1
        before, last = last, now
    return last[-1]


def words(title: str | None, source: str | None = None) -> list[str]:
    """Words of a headline in their one spelling, without the name of its site at the end."""
    if not title:
        return []
    text = fold(title).strip()
    if source and (m := _SUFFIX.search(text)):
        site = fold(source.replace("_", " "))
        tail = " ".join(_WORD.findall(m.group(1)))
        if _close(tail, site, 3):
            text = text[: m.start()]
    return [spelling(w) for w in _WORD.findall(text)]


class Speller:
    """Corrects words that are a few slips away from exactly one frequent word."""

    def __init__(self, frequent: list[str], most: int = 2, least: int = 5):
        self.frequent = set(frequent)
        self.most, self.least = most, least
        self.index: dict[str, list[str]] = {}
        for w in frequent:
            if len(w) >= least and not w.isdigit():
                for d in self._deletes(w):
                    self.index.setdefault(d, []).append(w)
        self.memo: dict[str, str] = {}

    def _deletes(self, w: str, most: int | None = None) -> set[str]:
        level, out = [(0, w)], [w]
        for _ in range(self.most if most is None else most):
            # from left to right, so that each choice of letters is made once
            level = [(i, x[:i] + x[i + 1 :]) for start, x in level for i in range(start, len(x))]
            out += [x for _, x in level]
        return set(out)

    def _allowed(self, w: str) -> int:
        return 1 if len(w) < 8 else self.most

    def near(self, w: str) -> set[str]:
        """Other frequent words that ``w`` may be a slip of."""
        found = {x for d in self._deletes(w) for x in self.index.get(d, ())} - {w}
        return {x for x in found if edits(w, x, self.most) <= self._allowed(w)}

    def __call__(self, w: str) -> str:
        if w in self.frequent or w in MARKERS or len(w) < self.least - 1 or any(c.isdigit() for c in w):
            return w
        got = self.memo.get(w)
        if got is None:
            best: dict[int, set[str]] = {}
            allowed = self._allowed(w)
            # (words that lie within what is allowed share what so many deletions leave)
            for x in {x for d in self._deletes(w, allowed) if d in self.index for x in self.index[d]}:
                best.setdefault(edits(w, x, self.most), set()).add(x)
            k = min(best, default=99)
            got = next(iter(best[k])) if k <= allowed and len(best[k]) == 1 else w
            if len(self.memo) < 500_000:
                self.memo[w] = got
        return got


def without_slips(uses: dict[str, int], times: int = 50) -> list[str]:
    """Frequent words but those that are a slip away from a word that is used ``times`` as often."""
    spell = Speller(list(uses))
    return [w for w in uses if len(w) < spell.least or w in MARKERS or not any(uses[x] >= times * uses[w] for x in spell.near(w))]
