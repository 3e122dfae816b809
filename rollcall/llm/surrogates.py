"""Personal data replaced by keyed surrogates of the same type and form, distinct where the entities are.

Detected: e-mail addresses, IPv4 addresses, card and account numbers (13 to 19 digits), telephone numbers, secrets after a
naming word (``token = "..."``), and names after a title, which also tells the gender; the words of such a name are replaced
wherever else they stand in the same text. A mention is reduced to its entity
(lower case, digits alone); the entity's surrogate is a keyed permutation of all strings of its form: a letter gives a letter
of the same script, a digit a digit, everything else stays. Card numbers keep passing or failing the check digit, IPv4
addresses stay in the unicast range, a telephone number keeps its country code, an e-mail address its last domain label, and equal domains get
equal surrogates. A given name becomes one of the same gender and script, a family name one of the same script; each word has its own
surrogate, so that a person met with and without the given name stays the same person. The mention's separators and
letter case are put back.

*Collision checks.* The distinct entities of the table are checked: a surrogate that is itself an entity of the table, or that
another entity has, is drawn again under the next attempt number (the smallest entity keeps a shared one), until none is
left. Attempts above 0 are few; up to ``BROADCAST_ENTITIES`` they are broadcast to the pass that rewrites the texts, beyond
that each text is joined to its own. So equal entities always get equal surrogates, different ones different.

Cases: null texts stay null, empty ones empty. Texts without an entity stay as they are. Repeated rows are rewritten alike. An empty
table gives an empty result. All columns of the input are kept; new columns take longer names if theirs are taken.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import cut, free_name

BROADCAST_ENTITIES = 100_000
#: From this attempt on a surrogate may be longer than its entity, so that no form runs out.
WIDER = 8
#: What a text with an entity holds; for Java.
CUE = r"(?U)@|\d{3}|\d\.\d|(?i:token|secret|password|api.?key)|\b(?:Mr|Mrs|Ms|Miss|Sir|Lady|Herr|Frau|Señora?|Sra?|Monsieur|Madame|Mme|Господин|Госпожа|Κύριος|Κυρία)\b"
_MALE, _FEMALE = ("Mr", "Sir", "Herr", "Señor", "Sr", "Monsieur", "Господин", "Κύριος"), ("Mrs", "Ms", "Miss", "Lady", "Frau", "Señora", "Sra", "Madame", "Mme", "Госпожа", "Κυρία")
_NAME = r"[^\W\d_a-zß-öø-ÿа-яёα-ωϊ-ώά-ίΐΰ][^\W\d_]+(?:[-’'][^\W\d_]+)*"
#: A local part has at most 64 characters, so a text without a gap is read in linear time.
_EMAIL = r"(?P<email>[\w.+-]{0,63}\w@(?:[\w-]+\.)+[A-Za-z]{2,})|"
_REST = (
    r"(?P<secret>(?<=[=:]\s\")[\w+/=-]{16,}(?=\")|(?<=[=:]\")[\w+/=-]{16,}(?=\"))"
    r"|(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))"
    r"|(?P<card>(?<![\d+(-])\d(?:[ -]?\d){12,18}(?![\d-]))"
    r"|(?P<phone>(?<![\w+])(?!(?:19|20)\d\d[-./ ]\d\d?[-./ ]\d\d?\b)(?:\+\d{1,3}[ .-]?)?\(?\d{2,4}\)?(?:[ .-]\d{2,4}){1,3}(?![\w-]|\.\d)|(?<![\w+])\+\d{8,15}(?!\w))"
    r"|(?P<title>\b(?:" + "|".join(_MALE + _FEMALE) + r")\b\.?[ ](?P<name>" + _NAME + r"(?:[ ]" + _NAME + r"){0,2}))"
)
_FIND, _FIND_NO_EMAIL = re.compile(_EMAIL + _REST), re.compile("(?P<email>(?!))|" + _REST)
_WORD = re.compile(r"[^\W\d_]+(?:[-’'][^\W\d_]+)*")
_ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "àáâãäåæçèéêëìíîïñòóôõöøœùúûüýÿß", "абвгдежзийклмнопрстуфхцчшщъыьэюяё", "αβγδεζηθικλμνξοπρστυφχψω")
_CLASS = {c: a for a in ("0123456789", *_ALPHABETS) for c in a}
_GIVEN = {
    ("m", 0): "adam alan brian carl david eric frank george henry ivan jack karl leon mark nils oscar paul ralph simon victor",
    ("f", 0): "ada alice bella clara diana elena fiona greta helen irene julia karin laura maria nina olga paula rosa sonia vera",
    ("m", 2): "антон борис виктор глеб денис егор иван кирилл лев максим",
    ("f", 2): "алла вера галина дарья елена жанна инна лидия мария нина",
    ("m", 3): "ανδρεας γιωργος δημητρης ηλιας κωστας λουκας μανος νικος παυλος σταυρος",
    ("f", 3): "αννα βασω δαφνη ελενη ζωη ιωαννα κατερινα μαρια νικη σοφια",
}
_SYLLABLES = {
    0: "ba bel bor cam dar den fal gar hol jen kal lan mor nel pol ran sel tor val wen",
    2: "ба бел бор вин гор дан зор кал лан мор нев пол рос сан тов",
    3: "βα γαρ δελ ζαν καλ λαν μαρ νικ παν ρος σαλ τορ φαν χαρ ψαλ",
}


def _draw(key: bytes, *what: object) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, what)).encode(), key=key, digest_size=16).digest(), "big")


def permute(x: int, size: int, key: bytes, *tweak: object) -> int:
    """Keyed permutation of 0 .. size - 1: a Feistel network on the next power of four, walked until inside."""
    if size < 2:
        return x
    half = max(1, -(-(size - 1).bit_length() // 2))
    mask = (1 << half) - 1
    while True:
        left, right = x >> half, x & mask
        for i in range(6):
            left, right = right, left ^ (_draw(key, *tweak, i, right) & mask)
        x = left << half | right
        if x < size:
            return x


def _same_form(text: str, key: bytes, *tweak: object) -> str:
    """Keyed permutation of lower-case strings of one form."""
    value, size = 0, 1
    for c in text:
        if (a := _CLASS.get(c)) is not None:
            value, size = value * len(a) + a.index(c), size * len(a)
    shape = "".join(_CLASS[c][0] if c in _CLASS else c for c in text)
    value = permute(value, size, key, *tweak, shape)
    out = []
    for c in reversed(text):
        if (a := _CLASS.get(c)) is not None:
            value, at = divmod(value, len(a))
            c = a[at]
        out.append(c)
    return "".join(reversed(out))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _script(word: str) -> int:
    for c in word:
        for i in (2, 3):
            if c in _ALPHABETS[i]:
                return i
    return 0


def surrogate(kind: str, entity: str, attempt: int, key: bytes) -> str:
    """Entity that stands for ``entity`` at this attempt."""
    tweak = (kind, attempt)
    more = "0" * max(0, attempt - WIDER + 1)
    if kind == "email":
        local, _, domain = entity.rpartition("@")
        head, _, last = domain.rpartition(".")
        return f"{_same_form(local + more, key, *tweak)}@{_same_form(head, key, 'domain')}.{last}"
    if kind == "ip":
        a, b, c, d = map(int, entity.split("."))
        value, inside = a << 24 | b << 16 | c << 8 | d, 1 <= a <= 223
        while True:
            value = permute(value, 1 << 32, key, *tweak)
            if (1 <= value >> 24 <= 223) == inside:
                return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))
    if kind == "card":
        if _luhn(entity):
            body = _same_form(entity[:-1] + more, key, *tweak)
            return next(body + c for c in "0123456789" if _luhn(body + c))
        out = entity + more
        while True:
            out = _same_form(out, key, *tweak)
            if not _luhn(out):
                return out
    if kind == "phone":
        kept, _, rest = entity.rpartition(" ")
        return f"{kept} {_same_form(rest + more, key, *tweak, kept)}" if kept else _same_form(rest + more, key, *tweak)
    if kind == "family":
        syllables = _SYLLABLES[_script(entity)].split()
        n = _draw(key, *tweak, entity)
        out = []
        for _ in range(3 + attempt // 4):
            n, at = divmod(n, len(syllables))
            out.append(syllables[at])
        return "".join(out)
    if kind.startswith("given"):
        script = _script(entity)
        names = _GIVEN[kind[-1], script].split()
        n, at = divmod(_draw(key, *tweak, entity), len(names))
        if attempt < 4:
            return names[at]
        # one syllable more at each attempt, so that many names are settled in few
        syllables, out = _SYLLABLES[script].split(), ""
        for _ in range(attempt - 3):
            n, k = divmod(n, len(syllables))
            out += syllables[k]
        return f"{names[at]}-{out}"
    if re.fullmatch("[0-9a-f]+", entity):  # a secret in hexadecimal digits stays one
        size = len(entity + more)
        return f"{permute(int(entity + more, 16), 16**size, key, *tweak, size):0{size}x}"
    return _same_form(entity + more, key, *tweak)


def _refit(mention: str, entity: str) -> str:
    """``entity`` in the separators and letter case of ``mention``."""
    out, at = [], 0
    for c in mention:
        if c.isalnum() and at < len(entity):
            out.append(entity[at].upper() if c.isupper() else entity[at])
            at += 1
        elif not c.isalnum():
            out.append(c)
    rest = entity[at:]
    return "".join(out) + (rest.upper() if len(mention) > 1 and mention.isupper() else rest)


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """(begin, end, kind, entity) of each mention, in order; the words of a name one by one, and again wherever they stand without a title."""
    found = list(_marked(text))
    names: dict[str, tuple[str, str]] = {}
    for begin, end, kind, entity in found:
        if kind == "family" or kind.startswith("given"):
            names.setdefault(text[begin:end], (kind, entity))
            names.setdefault(text[begin:end].upper(), (kind, entity))
    return sorted(found + list(_bare(text, found, names))) if names else found


def _bare(text: str, found: list[tuple[int, int, str, str]], names: dict[str, tuple[str, str]]) -> Iterator[tuple[int, int, str, str]]:
    """The words of ``names`` between the mentions found, also before an apostrophe."""
    at = 0
    for begin, end, _, _ in [*found, (len(text), len(text), "", "")]:
        for m in _WORD.finditer(text, at, begin):
            word = m[0]
            if word not in names:
                word = re.split("[’']", word, maxsplit=1)[0]
            if word in names:
                yield m.start(), m.start() + len(word), *names[word]
        at = end


def _marked(text: str) -> Iterator[tuple[int, int, str, str]]:
    for m in (_FIND if "@" in text else _FIND_NO_EMAIL).finditer(text):
        kind, said = m.lastgroup, m[0]
        if kind == "name":
            kind = "title"
        if m["email"]:
            yield m.start(), m.end(), "email", said.lower()
        elif m["secret"]:
            yield m.start(), m.end(), "secret", said.lower()
        elif m["ip"]:
            yield m.start(), m.end(), "ip", ".".join(str(int(x)) for x in said.split("."))
        elif m["card"]:
            yield m.start(), m.end(), "card", re.sub(r"\D", "", said)
        elif m["phone"]:
            digits = re.sub(r"\D", "", said)
            if 8 <= len(digits) <= 15:
                code = re.match(r"\+(\d{1,3})(?=[ .(-])", said)
                yield m.start(), m.end(), "phone", f"+{code[1]} {digits[len(code[1]):]}" if code else digits
        elif m["title"]:
            gender = "m" if re.match(r"[^\W\d_]+", said)[0] in _MALE else "f"
            words = list(re.finditer(r"\S+", m["name"]))
            base = m.start("name")
            for i, w in enumerate(words):
                part = "family" if i == len(words) - 1 else f"given-{gender}"
                yield base + w.start(), base + w.end(), part, w[0].lower()


def rewrite(text: str, attempts: dict[tuple[str, str], int], key: bytes) -> tuple[str, int]:
    """Text with surrogates, and how many."""
    out, at, n = [], 0, 0
    for begin, end, kind, entity in mentions(text):
        new = _cached(kind, entity, attempts.get((kind, entity), 0), key)
        said = text[begin:end]
        if kind in ("email", "ip"):
            new = new if not said.isupper() else new.upper()
        elif kind == "phone":
            code, _, rest = new.rpartition(" ")
            new = code + _refit(said[len(code) :], rest) if code else _refit(said, rest)
        elif kind in ("family",) or kind.startswith("given"):
            new = new.upper() if len(said) > 1 and said.isupper() else "-".join(w.capitalize() for w in new.split("-"))
        else:
            new = _refit(said, new)
        out += [text[at:begin], new]
        at, n = end, n + 1
    return "".join([*out, text[at:]]), n


@lru_cache(maxsize=50_000)
def _cached(kind: str, entity: str, attempt: int, key: bytes) -> str:
    return surrogate(kind, entity, attempt, key)


def entities(docs: DataFrame, text_col: str, key: bytes) -> DataFrame:
    """Stored distinct entities (kind, entity) with the attempt number that leaves no collision, and their surrogate."""

    @F.pandas_udf("array<struct<kind string, entity string>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([[{"kind": k, "entity": e} for k, e in dict.fromkeys((k, e) for _, _, k, e in mentions(t))] for t in s])

    @F.pandas_udf("string")
    def drawn(kind: pd.Series, entity: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, e, a, key) for k, e, a in zip(kind, entity, attempt, strict=True)], dtype=object)

    texts = docs.select(F.col(text_col).alias("t")).filter(F.col("t").rlike(CUE))
    now = cut(
        texts.select(F.explode(found("t")).alias("e")).select("e.kind", "e.entity").distinct()
        .withColumn("attempt", F.lit(0)).withColumn("surrogate", drawn("kind", "entity", "attempt"))
    )
    while True:
        real = now.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("real"))
        owner = now.groupBy("kind", "surrogate").agg(F.min("entity").alias("owner"), F.count("*").alias("n"))
        bad = owner.join(real, ["kind", "surrogate"], "left").filter("n > 1 OR real")
        again = (
            now.join(bad, ["kind", "surrogate"])
            .filter("real OR entity <> owner")
            .select("kind", "entity", (F.col("attempt") + 1).alias("attempt"))
        )
        again = cut(again.withColumn("surrogate", drawn("kind", "entity", "attempt")))
        if again.isEmpty():
            return now
        now = cut(now.join(again, ["kind", "entity"], "left_anti").unionByName(again))


def replace(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with the surrogates in ``text_col``, and a last column ``n_replaced``."""
    name, extra = free_name(docs.columns, "n_replaced"), free_name(docs.columns, "_drawn")
    drawn_again = entities(docs, text_col, key).filter("attempt > 0").select("kind", "entity", "attempt")
    schema = "text string, n int"
    has = F.col(text_col).rlike(CUE)
    touched, rest = docs.filter(has), docs.filter(~F.coalesce(has, F.lit(False)))

    def rows(texts: pd.Series, attempts) -> pd.DataFrame:
        return pd.DataFrame([rewrite(t, a, key) for t, a in zip(texts, attempts, strict=True)], columns=["text", "n"])

    if drawn_again.count() <= BROADCAST_ENTITIES:
        held = docs.sparkSession.sparkContext.broadcast({(r[0], r[1]): r[2] for r in drawn_again.collect()})

        @F.pandas_udf(schema)
        def write(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for s in batches:
                yield rows(s, [held.value] * len(s))

        done = touched.withColumn(extra, write(text_col))
    else:

        @F.pandas_udf("array<struct<kind string, entity string>>")
        def found(s: pd.Series) -> pd.Series:
            return pd.Series([[{"kind": k, "entity": e} for k, e in dict.fromkeys((k, e) for _, _, k, e in mentions(t))] for t in s])

        @F.pandas_udf(schema)
        def write_own(text: pd.Series, own: pd.Series) -> pd.DataFrame:
            return rows(text, [{(x["kind"], x["entity"]): x["attempt"] for x in (o if o is not None else ())} for o in own])

        digest = F.sha2(F.col(text_col).cast("binary"), 256)
        by_text = touched.select(digest.alias("_text"), F.explode(found(text_col)).alias("e")).select("_text", "e.*").distinct()
        own = by_text.join(drawn_again, ["kind", "entity"]).groupBy("_text").agg(F.collect_list(F.struct("kind", "entity", "attempt")).alias("_own"))
        key_col, own_col = free_name(docs.columns, "_text"), free_name(docs.columns, "_own")
        own = own.withColumnsRenamed({"_text": key_col, "_own": own_col})
        done = touched.withColumn(key_col, digest).join(own, key_col, "left").withColumn(extra, write_own(text_col, own_col))
    cols = [F.col(f"{extra}.text").alias(c) if c == text_col else F.col(c) for c in docs.columns]
    return done.select(*cols, F.col(f"{extra}.n").alias(name)).union(rest.withColumn(name, F.lit(0)))
