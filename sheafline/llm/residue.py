"""Template residue, filler and error pages in text fields: positive-unlabelled naive Bayes by expectation-maximisation.

Trusted positives are short values that plainly are an error message, a notice, filler or an unfilled template (patterns
below); everything else is unlabelled. Naive Bayes over words and word pairs of passages (sentences and lines) starts with
all unlabelled passages as content and alternates between soft labels for them and new parameters; trusted ones stay
fixed. There are two residue classes, because they are judged differently when a record is decided:

* messages (errors, notices, access walls) make a value residue only if no passage of real content stands beside them;
* filler and unfilled placeholders make it residue wherever they stand.

Lines of page furniture count neither way; a value without any content passage is residue. Features that the fitting rows
do not have are ignored, so an invented name speaks neither way, and content needs positive evidence or many plain words.
Null and blank values are no cases. The model is fitted on at most ``bound`` unlabelled and ``bound`` trusted values
(those whose id hashes lowest); every value is scored, in full length.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm import passages as P
from sheafline.llm.boilerplate import HEADINGS
from sheafline.session import spread

CONTENT, MESSAGE, FILLER = 0, 1, 2

# Unfilled placeholders of common template languages.
PLACEHOLDER = re.compile(
    r"\{\{[^{}\n]{1,60}\}\}|\$\{[^{}\n]{1,60}\}|<%=?[^%\n]{1,60}%>|\[\[[^\[\]\n]{1,60}\]\]|%%[A-Za-z_.]{2,40}%%|@@[A-Za-z_.]{2,40}@@|%\([A-Za-z_.]{1,40}\)[sd]"
    r"|(?<![\w$])\{[A-Za-z_.]{3,40}\}|\[(?:INSERT|YOUR|ENTER|ADD)\b[^\[\]\n]{1,60}\]|<[A-Za-z_. ]{2,40} goes here>|\[object Object\]"
)
# Trusted examples: what may be said of a whole short value.
TRUSTED_MESSAGE = re.compile(
    r"^(?:(?:http|error) )?(?:40[0-9]|41[0-9]|429|50[0-9])\b.{0,160}$|javascript .{0,30}(?:disabled|required)|enable javascript|activer javascript|aktivieren sie javascript|habilite javascript|active javascript"
    r"|^access denied|^request blocked|^forbidden|bad gateway|gateway timeout|internal server error|service unavailable\W*(?:$|the|we|please|request)|^page not found"
    r"|wurde nicht gefunden|page demandée est introuvable|no encontramos la página|servicio no disponible|momentanément indisponible|nicht erreichbar"
    r"|verify(?:ing)? that you are human|checking your browser|security check|too many requests|session has expired|scheduled maintenance|traceback \(most recent"
    r"|fatal error|database connection|(?:could not|cannot) be (?:opened|loaded|shown|found|retrieved)",
    re.I | re.S,
)
TRUSTED_FILLER = re.compile(
    r"\blorem ipsum\b|^(?:asdf|test|xxx+|foo|qwerty)(?:[\s.]+(?:asdf|test|xxx+|bar|foo|qwerty))*\W*$|^\W*(?:placeholder|undefined|null|none|nan|n/a|tbd|todo)\b\W*(?:$|:? ?\w+ \w+$)|sample text|dummy text|blindtext"
    r"|your text goes here|texte provisoire|texto de ejemplo|beispieltext|content coming soon|to be (?:supplied|added|filled)|will be filled in later|(?:abstract text ?){2,}|no description provided|being prepared, check back",
    re.I,
)
# Phrases by which a page addresses its visitor or names its publisher, for lower-case lines of any length.
# Each is tried only on lines that contain one of its parts, which is far cheaper than the pattern itself.
CUES = {
    r"©|\(c\) \d{4}|\bcopyright \d{4}|all rights reserved|alle rechte vorbehalten|tous droits réservés|todos los derechos": ("©", "(c) ", "copyright", "rights reserved", "rechte vorbehalten", "droits réservés", "los derechos"),
    r"\b(?:we|site|website|partners|services?|page|us|journal|health|news|name) uses? (?:\w+ )?(?:cookies|trackers|tracking)|(?:we|partners) (?:process|store) device|small files on your device|\buses cookies\b|\bwe use cookies\b": ("cookies", "track", "device"),
    r"(?:verwenden|nutzen|nutzt|verwendet) (?:cookies|tracking)|utilis\w+ des (?:cookies|traceurs)|stockent des informations|usamos cookies|utiliza (?:cookies|identificadores)": ("cookies", "track", "traceurs", "stockent des", "identificadores"),
    r"by continuing|mit klick auf|stimmen sie zu|en poursuivant|al continuar|\bgot it\b|\(\d+ partners\)|manage choices|accept all|alle akzeptieren|tout accepter|aceptar todo": ("continu", "klick", "stimmen sie", "poursuivant", "got it", "partners)", "manage", "accept", "akzeptieren", "aceptar"),
    r"\bis published by\b|wird herausgegeben von|est (?:publié|édité) par|es una publicación de": ("published by", "herausgegeben von", "é par", "publicación de"),
    r"enter your email|in your inbox|sign up for (?:the|our)|subscribers can|readers who get|enjoying this|support independent|support our (?:work|journalism)|get the (?:latest|best)": ("email", "inbox", "sign up for", "subscribers can", "readers who", "enjoying", "support", "get the"),
    r"book (?:today|now)|buy now|find clinics near|special offer|jetzt buchen|réservez|reserve (?:hoy|ahora)": ("book ", "buy now", "clinics near", "special offer", "jetzt buchen", "réservez", "reserve "),
}
# The same, at the start of a line.
STARTS = (
    r"(?:advertisement|sponsored|anzeige|publicité|publicidad)\b|(?:follow|folgen sie|suivez|siga a)\b|(?:most read|read next|related|you may also like|more from|trending|latest)\b"
    r"|(?:skip to|back to|zum inhalt|nach oben|aller au|haut de|saltar al|volver arriba)\b|(?:share|print|email|save for|request|report a|listen to|text size|comments)\b.{0,40}$"
)
_COMPILED = [(re.compile(c), parts) for c, parts in CUES.items()]
_STARTS = re.compile(STARTS)


def has_cue(low: str) -> bool:
    """Whether a lower-case line speaks for the page instead of the article."""
    return bool(_STARTS.match(low)) or any(any(x in low for x in parts) and c.search(low) for c, parts in _COMPILED)


_SEPARATED = re.compile(r"\S(?:\s*[|>»•·]\s*|\s{2,}|\t)\S.*\S(?:\s*[|>»•·]\s*|\s{2,}|\t)\S")
_HEADING = frozenset(HEADINGS)
_MARK = " unfilledplaceholder "
_END = re.compile(r"[.!?…][\"'”’»)\]]{0,3}(?:\s?\[\d+\])?$|\)$")


_judged: dict[str, bool] = {}  # short lines recur on many pages; bounded, and the functions travel with it


def furniture_line(line: str) -> bool:
    """Whether a line of a page is a heading, a menu, a notice of the site or a bare title, from the line alone."""
    got = _judged.get(line)
    if got is None:
        low = line.lower().strip()
        got = bool(has_cue(low) or _SEPARATED.search(line) or low.strip(":. ") in _HEADING)
        if len(line) < 100 and len(_judged) < 5_000:
            _judged[line] = got
    return got


def trusted(value: str) -> int:
    """Class of a value that plainly is residue, else content (that is: unlabelled)."""
    v = value.strip()
    if len(v) > 400:
        return CONTENT
    if PLACEHOLDER.search(v):
        return FILLER if len(PLACEHOLDER.sub("", v)) < 80 else CONTENT
    if TRUSTED_FILLER.search(v) and len(v) < 300 and len(re.findall(r"\b(?:of|the|and)\b", v)) < 4:
        return FILLER
    if TRUSTED_MESSAGE.search(v) and len(v) < 160:
        return MESSAGE
    return CONTENT


class Model:
    """Log-odds of words for the three classes."""

    def __init__(self, bits: int = 18, alpha: float = 0.5, least: int = 2, rounds: int = 4, sure: float = 0.999):
        self.bits, self.alpha, self.least, self.rounds, self.sure = bits, alpha, least, rounds, sure

    def fit(self, rows: list[np.ndarray], labels: np.ndarray) -> Model:
        """``labels``: trusted class, or content for unlabelled rows."""
        size = 1 << self.bits
        sizes = np.array([len(r) for r in rows], np.int64)
        cols = np.concatenate(rows) if rows else np.empty(0, np.int64)
        owner = np.repeat(np.arange(len(rows)), sizes)
        self.known = np.bincount(cols, minlength=size) >= self.least
        keep = self.known[cols]
        cols, owner = cols[keep], owner[keep]
        fixed = labels != CONTENT
        soft = np.zeros((len(rows), 3))
        soft[np.arange(len(rows)), labels] = 1
        for _ in range(self.rounds):
            counts = np.stack([np.bincount(cols, weights=soft[owner, k], minlength=size) for k in range(3)]) + self.alpha
            counts[:, ~self.known] = 1
            total = soft.sum(axis=0) + 2 * self.alpha
            self.weights = np.log(counts / total[:, None]).astype(np.float32)
            self.weights[:, ~self.known] = 0
            self.prior = np.log(total / total.sum())
            like = np.stack([np.bincount(owner, weights=self.weights[k][cols], minlength=len(rows)) for k in range(3)], axis=1) + self.prior
            like -= like.max(axis=1, keepdims=True)
            p = np.exp(like)
            p /= p.sum(axis=1, keepdims=True)
            p[:, FILLER] = 0  # fillers are written alike, so the trusted ones suffice; else any rare wording would drift there
            p[:, CONTENT] = 1 - p[:, MESSAGE]
            p[p[:, MESSAGE] < self.sure] = (1, 0, 0)  # a passage leaves the content only on strong evidence
            soft[~fixed] = p[~fixed]
        return self

    def classes(self, row: np.ndarray) -> tuple[np.ndarray, int]:
        """Probabilities of the classes and the number of known features."""
        row = row[self.known[row]]
        like = self.weights[:, row].sum(axis=1) + self.prior
        p = np.exp(like - like.max())
        return p / p.sum(), len(row)

    def leaning(self, ts: list[str], to: int) -> float:
        """Share of the known words that are clearly likelier in one class than in content."""
        row = P.features(ts, self.bits, pairs=False)
        row = row[self.known[row]]
        return float((self.weights[to, row] > self.weights[CONTENT, row] + 1).mean()) if len(row) else 0.0


def units(value: str, page: bool) -> list[tuple[list[str], bool]]:
    """Tokens of each passage that may be content or residue, and whether it has the form of prose.

    Placeholders become one token. Of a page, lines of furniture and bare lines (titles, menu entries, headings, list
    entries) are left out, unless nothing else is there.
    """
    full: list[tuple[list[str], bool]] = []
    bare: list[tuple[list[str], bool]] = []
    for line in PLACEHOLDER.sub(_MARK, value).split("\n"):
        line = line.strip()
        if not line or (page and _MARK.strip() not in line and furniture_line(line)):
            continue
        prose = not page or (bool(_END.search(line)) and len(line.split()) >= 4)
        for passage in P.passages(line):
            ts = P.tokens(passage)
            if ts:
                (full if prose or _MARK.strip() in ts else bare).append((ts, prose))
    return full or bare


def judge(value: str | None, model: Model, page: bool) -> tuple[bool, float]:
    """Whether a value is residue, and its highest residue probability. ``page``: lines of furniture may stand around."""
    if value is None or not value.strip():
        return False, 0.0
    content, filler, worst = 0, False, 0.0
    for ts, prose in units(value, page):
        p, known = model.classes(P.features(ts, model.bits))
        worst = max(worst, float(p[MESSAGE] + p[FILLER]))
        if _MARK.strip() in ts or (len(ts) >= 4 and known >= 5 and p[FILLER] > 0.99 and model.leaning(ts, FILLER) >= 0.7):
            filler = True
        elif p[CONTENT] > 0.5 and prose and known >= max(4, len(ts) // 3):
            content += 1
    return filler or content == 0, worst if content and not filler else 1.0


def fields(pages: DataFrame, id_col: str, names: list[str]) -> DataFrame:
    """``id, field_name, value``: one row per field of a row; null and blank values left out."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("field_name"), F.col(n).cast("string").alias("value")) for n in names])).alias("f")
    rows = spread(pages.select(F.col(id_col).cast("long").alias(id_col), *names)).select(F.col(id_col).alias("id"), pairs).select("id", "f.field_name", "f.value")
    return rows.where(F.col("id").isNotNull() & F.col("value").rlike(r"(?U)\S"))


def fit(rows: DataFrame, page_fields: tuple[str, ...] = ("text",), bound: int = 4_000) -> Model:
    """The model, from at most ``bound`` trusted and ``bound`` unlabelled values."""
    label = F.col("label")

    def of(b: pd.DataFrame) -> pd.DataFrame:
        return b.assign(label=[trusted(_kernel(v, f in page_fields)) if _maybe(v, f in page_fields) else CONTENT for v, f in zip(b["value"], b["field_name"])])

    labelled = P.map_batches(rows.withColumn("key", F.concat_ws(" ", "id", "field_name")), of, "id long, field_name string, value string, key string, label int")
    positive = P.sample(labelled.where(label != CONTENT), "key", bound)
    unlabelled = P.sample(rows.withColumn("key", F.concat_ws(" ", "id", "field_name")), "key", bound)
    taken = set(positive["key"])
    feats, labels = [], []
    model = Model()
    for frame in (positive, unlabelled):
        for v, f, key, y in zip(frame["value"], frame["field_name"], frame["key"], frame.get("label", pd.Series(0, index=frame.index))):
            if frame is unlabelled and key in taken:
                continue
            for ts, _ in units(v, f in page_fields):
                if y == FILLER and _MARK.strip() in ts:
                    ts = [_MARK.strip()]  # the words around a placeholder are those of articles
                feats.append(P.features(ts, model.bits))
                labels.append(y)
    _judged.clear()  # not to be sent along
    return model.fit(feats, np.array(labels, np.int64))


def _maybe(value: str, page: bool) -> bool:
    """Whether a value can be a trusted example: what is longer than those is furniture, whose lines are short."""
    if not page:
        return len(value) <= 600
    return sum(len(x) for x in value.split("\n") if len(x) > 180) <= 400


def _kernel(value: str, page: bool) -> str:
    """A page's text without lines that are furniture; other fields as they are."""
    if not page:
        return value
    return "\n".join(x for x in (y.strip() for y in value.split("\n")) if x and not furniture_line(x))


def residue(pages: DataFrame, id_col: str = "page_id", names: tuple[str, ...] = ("text", "abstract"), page_fields: tuple[str, ...] = ("text",), bound: int = 4_000, fitted: tuple[str, ...] | None = None) -> DataFrame:
    """``id, field_name, residue, score`` of each value that is neither null nor blank.

    ``fitted``: the fields that the model is fitted on, if they are others than those judged.
    """
    rows = fields(pages, id_col, list(names))
    model = fit(fields(pages, id_col, list(fitted or names)), page_fields, bound)
    shared = P.shipped(pages.sparkSession, model)  # size fixed by the number of hash bits

    def apply(b: pd.DataFrame) -> pd.DataFrame:
        out = [judge(v, shared(), f in page_fields) for v, f in zip(b["value"], b["field_name"])]
        return pd.DataFrame({"id": b["id"], "field_name": b["field_name"], "residue": [r for r, _ in out], "score": [float(s) for _, s in out]})

    return P.map_batches(rows, apply, "id long, field_name string, residue boolean, score double")
