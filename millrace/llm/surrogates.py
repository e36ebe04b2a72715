"""Personal data replaced by surrogates of the same kind.

A first pass over all texts finds entities and keeps a keyed digest and the shape of each, never its text. The surrogate
follows from digest and shape alone, so mentions of one entity get the same surrogate in all documents, in the format
of each mention: separators, case, length, script, check digits, and the gender that a title gives. Surrogates are then
checked over the whole corpus: none may be that of two entities, and none may be an entity of the corpus itself. Where
one is, the entity that comes later by digest is given its next surrogate, round after round until all are distinct;
these few exceptions reach the documents that mention them by a join. The second pass writes the texts anew.

Null texts stay null, and rows without entities stay as they are. A null identifier is no different from others.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, stored

# Titles by the gender they give.
MALE = ["Mr", "Herr", "Sr", "Señor", "Monsieur", "Signor", "Господин", "г-н", "Г-н", "Κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Sra", "Señora", "Mme", "Madame", "Signora", "Госпожа", "г-жа", "Г-жа", "Κυρία"]
NEUTRAL = ["Dr", "Prof"]
HAN_TITLES = {"先生": "m", "女士": "f", "小姐": "f", "さん": "n"}

# Syllables of surrogate names by script, and their ends by gender.
SYLLABLES = {
    "latin": "ba bel cor da del fen gar hal jo kel lan mar nor or pel ra sel tan ul ver wil".split(),
    "cyrillic": "ба бел вер гар дан ел зар ив кол лан мар нор ол пер рад сел тар ул фен".split(),
    "greek": "αλ βαρ γεν δελ ερ ζαν θε καλ λαρ μεν νικ ορ παλ ριν σελ ταρ φιλ".split(),
    "han": list("安博昌德恩方光海和嘉康立明宁平青荣思天文祥雅远志"),
}
ENDS = {
    ("latin", "m"): ["an", "o", "us", "ert"], ("latin", "f"): ["a", "ina", "elle", "ia"], ("latin", "n"): ["is", "en", "el", "in"],
    ("cyrillic", "m"): ["ов", "ин", "ан"], ("cyrillic", "f"): ["ова", "ина", "ана"], ("cyrillic", "n"): ["ко", "ич", "ен"],
    ("greek", "m"): ["ος", "ης", "ας"], ("greek", "f"): ["α", "η", "ου"], ("greek", "n"): ["ι", "ις", "ων"],
    ("han", "m"): list("伟强军刚"), ("han", "f"): list("娜丽芳敏"), ("han", "n"): list("华林晨宇"),
}
# Letters that stand for others of their script and case, with the first and the last of them.
ALPHABETS = {
    "a": ("a", "z"), "A": ("A", "Z"), "я": ("а", "я"), "Я": ("А", "Я"), "ω": ("α", "ρ"), "Ω": ("Α", "Ρ"),
    "汉": ("一", "鿿"), "あ": ("か", "ま"), "ア": ("カ", "マ"), "한": ("가", "힣"), "é": ("à", "ö"), "É": ("À", "Ö"),
}
DIGITS, FIRST, HEX, UPPER_HEX = "0123456789", "123456789", "0123456789abcdef", "0123456789ABCDEF"

EMAIL = re.compile(r"(?<![\w.+%-])[\w.+%-]{1,64}@(?:[\w-]{1,63}\.){1,8}[^\W\d_]{2,63}")
IPV4 = re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)")
IPV6 = re.compile(r"(?<![:\w])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![:\w])")
LONG_HEX = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])")
SECRET = re.compile(r"(?i)\b(?:api[_-]?key|token|secret|password|passwd|pwd)\b[\"']?\s*[:=]\s*[\"']?([^\s\"']{6,})")
IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
CARD = re.compile(r"(?<!\d)(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}(?:[ -]\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)")
SOCIAL = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")
PHONE = re.compile(
    r"(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}"
    r"|(?:1[ .-])?(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[ .-]\d{4})(?!\d)"
)
TITLES = "|".join(sorted((re.escape(t) for t in MALE + FEMALE + NEUTRAL), key=len, reverse=True))
PERSON = regex.compile(rf"(?<!\w)({TITLES})\.?\s+(\p{{Lu}}[\p{{L}}'’-]+(?:\s+\p{{Lu}}[\p{{L}}'’-]+){{0,2}})")
HAN_PERSON = regex.compile(rf"(\p{{Han}}{{2,3}})({'|'.join(HAN_TITLES)})")
GENDER = {**dict.fromkeys(MALE, "m"), **dict.fromkeys(FEMALE, "f"), **dict.fromkeys(NEUTRAL, "n")}


class Mention(NamedTuple):
    start: int
    end: int
    kind: str
    shape: str
    canonical: str


def letter_class(c: str) -> str:
    """The character of a shape that stands for `c`; a backslash before it means the character itself."""
    if c.isdigit() and c.isascii():
        return "0"
    for stands_for, (low, high) in ALPHABETS.items():
        if low <= c <= high:
            return stands_for
    return "\\" + c


def shape_of(text: str) -> str:
    return "".join(map(letter_class, text))


def luhn(digits: str) -> int:
    """What the digits' Luhn sum leaves by 10; 0 for valid ones."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def script_of(name: str) -> str:
    c = name[0]
    if "Ѐ" <= c <= "ӿ":
        return "cyrillic"
    if "Ͱ" <= c <= "Ͽ":
        return "greek"
    return "han" if "㐀" <= c <= "鿿" else "latin"


def literal(text: str) -> str:
    return "".join("\\" + c for c in text)


def mentions(text: str) -> list[Mention]:
    """The entities of a text from left to right; of two that overlap the more specific kind stands."""
    found: list[Mention] = []  # in order

    def add(start: int, end: int, kind: str, shape: str, canonical: str) -> Mention | None:
        new = Mention(start, end, kind, shape, canonical)
        at = bisect.bisect(found, new)
        if (at and found[at - 1].end > start) or (at < len(found) and found[at].start < end):
            return None
        found.insert(at, new)
        return new

    if "@" in text:
        for m in EMAIL.finditer(text):
            whole = m[0].lower()
            if len(whole) == len(m[0]):
                name, _, last = whole.rpartition(".")
                add(*m.span(), "email", shape_of(name) + "\\." + literal(last), whole)
    numbers = any(d in text for d in DIGITS)
    if numbers:
        for m in IBAN.finditer(text):
            plain = m[0].replace(" ", "")
            if iban_rest(plain) == 1:
                add(*m.span(), "iban", literal(plain[:2]) + shape_of(plain[4:]), plain)
        for m in IPV6.finditer(text):
            add(*m.span(), "ipv6", "".join("h" if c != ":" else "\\:" for c in m[0]), m[0].lower())
        for m in IPV4.finditer(text):
            if all(int(x) < 256 for x in m[0].split(".")):
                add(*m.span(), "ip", "ip", ".".join(str(int(x)) for x in m[0].split(".")))
        for m in LONG_HEX.finditer(text):
            if not m[0].isdigit() and not m[0].isalpha():
                add(*m.span(), "hex", "h" * len(m[0]), m[0].lower())
        for m in CARD.finditer(text):
            digits = re.sub(r"\D", "", m[0])
            add(*m.span(), "card", ("L" if luhn(digits) == 0 else "N") + digits[0] + str(len(digits)), digits)
        for m in SOCIAL.finditer(text):
            add(*m.span(), "social", "9" + "0" * 8, m[0].replace("-", ""))
        for m in PHONE.finditer(text):
            digits = re.sub(r"\D", "", m[0])
            if 7 <= len(digits) <= 15:
                code = re.match(r"\+(\d{1,3})(?=[ .(-])", m[0])
                kept = code[1] if code else ""
                if not m[0].startswith("+"):  # the code 1 may be left out
                    kept, digits = "1", digits if len(digits) == 11 else "1" + digits
                add(*m.span(), "phone", literal(kept) + "9" + "0" * (len(digits) - len(kept) - 1), digits)
    if "=" in text or ":" in text:
        for m in SECRET.finditer(text):
            add(*m.span(1), "secret", shape_of(m[1]), m[1])
    names: dict[str, Mention] = {}
    if any(t in text for t in GENDER):
        for m in PERSON.finditer(text):
            parts = list(regex.finditer(r"\S+", m[2]))
            for i, p in enumerate(parts):
                role = "family" if i == len(parts) - 1 else "given"
                gender = GENDER[m[1]] if role == "given" or script_of(p[0]) == "cyrillic" else "n"
                at = m.start(2) + p.start()
                new = add(at, at + len(p[0]), role, f"{script_of(p[0])} {gender}", p[0].casefold())
                if new:
                    names.setdefault(p[0], new)
    if any(t in text for t in HAN_TITLES):
        for m in HAN_PERSON.finditer(text):
            new = add(*m.span(1), "family", f"han {HAN_TITLES[m[2]]}", m[1])
            if new:
                names.setdefault(m[1], new)
    if names:  # further mentions of these names in the text, without a title
        for m in re.finditer(r"[^\W\d_][\w'’-]*", text):
            if m[0] in names:
                add(*m.span(), *names[m[0]][2:])
    return found


def digest_of(key: bytes, kind: str, shape: str, canonical: str) -> str:
    return hmac.new(key, f"{kind}\0{shape}\0{canonical}".encode(), hashlib.sha256).hexdigest()[:32]


def space_of(kind: str, shape: str) -> str:
    """Entities of one space must not look alike; names have one for each script."""
    return f"name {shape.split()[0]}" if kind in ("given", "family") else ""


def value_digest(key: bytes, kind: str, shape: str, canonical: str) -> str:
    """Digest of a value as it is read, whatever its kind and shape."""
    value = canonical.casefold() if kind in ("given", "family", "email", "hex", "ipv6") else canonical
    return hmac.new(key, f"value\0{space_of(kind, shape)}\0{value}".encode(), hashlib.sha256).hexdigest()[:32]


class Draw:
    """Numbers that follow from a digest and an attempt."""

    def __init__(self, key: bytes, digest: str, attempt: int) -> None:
        self.key, self.seed, self.n, self.pool = key, f"{digest}:{attempt}", 0, 0

    def below(self, most: int) -> int:
        block = hmac.new(self.key, f"{self.seed}:{self.n}".encode(), hashlib.sha256).digest()
        self.n += 1
        return int.from_bytes(block[:8], "little") % most

    def of(self, choices) -> str:
        return choices[self.below(len(choices))]


def surrogate(key: bytes, kind: str, shape: str, digest: str, attempt: int) -> str:
    """The canonical form of an entity's surrogate."""
    draw = Draw(key, digest, attempt)
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "card":
        digits = shape[1] + "".join(draw.of(DIGITS) for _ in range(int(shape[2:]) - 2))
        # The last digit makes the sum right, or wrong by what the digest says.
        right = next(d for d in DIGITS if luhn(digits + d) == 0)
        return digits + (right if shape[0] == "L" else str((int(right) + 1 + draw.below(9)) % 10))
    if kind in ("given", "family"):
        script, gender = shape.split()
        own = 1 if script == "han" else 2 + attempt // 4
        return "".join(draw.of(SYLLABLES[script]) for _ in range(own + attempt // 64)) + draw.of(ENDS[script, gender])
    out, at = [], 0
    while at < len(shape):
        c = shape[at]
        if c == "\\":
            at += 1
            out.append(shape[at])
        elif c == "0":
            out.append(draw.of(DIGITS))
        elif c == "9":
            out.append(draw.of(FIRST))
        elif c == "h":
            out.append(draw.of(HEX))
        else:
            low, high = map(ord, ALPHABETS[c])
            out.append(chr(low + draw.below(high - low + 1)))
        at += 1
    if kind == "iban":
        country, rest = "".join(out[:2]), "".join(out[2:])
        return f"{country}{98 - iban_rest(f'{country}00{rest}'):02d}{rest}"
    return "".join(out)


def render(mention: str, kind: str, canonical: str) -> str:
    """A surrogate in the format of a mention."""
    if kind in ("phone", "card", "social", "iban"):
        marks = iter(canonical[-sum(c.isalnum() for c in mention) :])
        return "".join(next(marks) if c.isalnum() else c for c in mention)
    if kind in ("email", "hex", "ipv6"):
        return "".join(s.upper() if c.isupper() and len(s.upper()) == 1 else s for c, s in zip(mention, canonical))
    if kind in ("given", "family"):
        return canonical.upper() if mention.isupper() and len(mention) > 1 else canonical.capitalize()
    return canonical


FOUND_SQL = "id bigint, tag bigint, kind string, shape string, digest string, value string"


def _finder(key: bytes):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for own, tag, text in zip(*[c.to_pylist() for c in batch.columns]):
                known = {
                    (m.kind, m.shape, digest_of(key, *m[2:]), value_digest(key, *m[2:])) for m in mentions(text or "")
                }
                rows += [(own, tag, *k) for k in sorted(known)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int64()] * 2 + [pa.string()] * 4)],
                names=["id", "tag", "kind", "shape", "digest", "value"],
            )

    return find


def _maker(key: bytes):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("kind", "shape", "digest", "attempt")]
            made = [surrogate(key, *row) for row in zip(*columns)]
            values = list(zip(columns[0], columns[1], made))
            more = [pa.array([of(key, *v) for v in values], pa.string()) for of in (value_digest, digest_of)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "new", "same"])

    return make


def _writer(key: bytes):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for own, text, later in zip(*[c.to_pylist() for c in batch.columns]):
                attempts = dict((x["digest"], x["attempt"]) for x in later or ())
                out, at, kinds = [], 0, []
                for m in mentions(text or ""):
                    digest = digest_of(key, m.kind, m.shape, m.canonical)
                    new = surrogate(key, m.kind, m.shape, digest, attempts.get(digest, 0))
                    out += [text[at : m.start], render(text[m.start : m.end], m.kind, new)]
                    at = m.end
                    kinds.append(m.kind)
                rows.append((own, "".join([*out, text[at:]]) if kinds else text, len(kinds), sorted(set(kinds))))
            types = [pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["id", "text", "n_entities", "kinds"]
            )

    return write


def distinct_attempts(entities: DataFrame, key: bytes, values: DataFrame | None = None) -> DataFrame | None:
    """Rows (digest, attempt) of the entities whose first surrogate is not theirs; None if there are none.

    `entities` has rows (kind, shape, digest). Surrogates are compared as they are read, over all kinds and shapes, and
    with the entities by `values`, rows (value) of all of them; without these, with those of their kind and shape.
    """
    spark = entities.sparkSession
    make = _maker(key)
    schema = "kind string, shape string, digest string, attempt int, new string, same string"
    own = entities.select("kind", "shape", "digest", F.lit(0).alias("attempt"))
    now = stored(own.mapInArrow(make, schema), "surrogates")
    taken_by = "same" if values is None else "new"
    taken = own.select(F.col("digest").alias("same")) if values is None else values.select(F.col("value").alias("new"))
    while True:
        least = now.df.groupBy("new").agg(F.min(F.struct("attempt", "digest")).alias("owner"))
        shared = now.df.join(least, "new").where("digest != owner.digest").select("digest")
        real = now.df.join(taken, taken_by, "left_semi").select("digest")
        later = stored(shared.union(real).distinct().withColumn("again", F.lit(1)), "shared")
        if later.df.isEmpty():
            break
        joined = now.df.join(later.df, "digest", "left").select(
            "kind", "shape", "digest", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt")
        )
        after = stored(joined.mapInArrow(make, schema), "surrogates")
        discard(spark, now, later)
        now = after
    exceptions = now.df.where("attempt > 0").select("digest", "attempt")
    return None if exceptions.isEmpty() else exceptions


def with_surrogates(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, text, n_entities, kinds) of every row of `docs`; `key` has to be kept secret."""
    tag = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tag")
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), tag, F.col(text_col).alias("text"))
    found = stored(texts.mapInArrow(_finder(key), FOUND_SQL), "entities").df
    exceptions = distinct_attempts(found.select("kind", "shape", "digest").distinct(), key, found.select("value").distinct())
    if exceptions is None:
        with_later = texts.select("id", "text", F.lit(None).cast("array<struct<digest:string,attempt:int>>").alias("later"))
    else:
        by_text = (
            found.select("id", "tag", "digest").distinct().join(exceptions, "digest")
            .groupBy(F.col("id").alias("of"), F.col("tag").alias("of_tag"))
            .agg(F.collect_list(F.struct("digest", "attempt")).alias("later"))
        )
        by_text = stored(by_text, "exceptions").df  # few, so Spark broadcasts it below its own limit
        same = texts["id"].eqNullSafe(by_text["of"]) & (texts["tag"] == by_text["of_tag"])
        with_later = texts.join(by_text, same, "left").select("id", "text", "later")
    return with_later.mapInArrow(_writer(key), "id bigint, text string, n_entities bigint, kinds array<string>")
