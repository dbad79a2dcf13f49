"""Personal data replaced by keyed surrogates of the same type and format.

Every kind of entity is read as a shape and a number below the count of entities of that
shape. A keyed permutation of those numbers (a Feistel network walked into range) gives the
surrogate (the next one on a secret circle through all), so equal entities always get equal
surrogates and different ones different surrogates, wherever they stand, without any lookup. What remains to be checked over all documents is that no
surrogate is an entity that really occurs: such a one goes on to the next free value, and no two to the same.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from math import prod

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import free_names, map_columns, without
from folioflow.scale import materialise

KINDS = ("email", "phone", "ip", "ipv6", "ssn", "card", "iban", "name")

# Given names by script and gender, in natural order.
GIVEN = {
    ("latin", "f"): "Alice Anna Carmen Charlotte Clara Elena Emma Greta Hannah Ingrid Isabel Julia Laura Lucía Maria Marie Sofia Sophie Susan".split(),
    ("latin", "m"): "Antonio Carlos David Diego Hans Henri James Jean John José Jürgen Klaus Lukas Michael Pablo Paul Peter Robert Thomas".split(),
    ("cyrillic", "f"): "Анна Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
    ("cyrillic", "m"): "Александр Алексей Владимир Дмитрий Иван Михаил Николай Сергей".split(),
    ("greek", "f"): "Αικατερίνη Βασιλική Ελένη Μαρία Σοφία".split(),
    ("greek", "m"): "Γεώργιος Δημήτριος Ιωάννης Κωνσταντίνος Νικόλαος".split(),
}
# Letters that a surname's letters are exchanged within, by script.
LETTERS = {
    "latin": ("aeiou", "bcdfghklmnprstvwz"),
    "cyrillic": ("аеиоуыэюя", "бвгджзклмнпрстфхцчш"),
    "greek": ("αεηιουω", "βγδζθκλμνξπρστφχψ"),
}
# What stands before a surname, with the gender it tells, and particles within surnames.
TITLES = {
    "m": "Mr Herr Herrn Monsieur Señor Sr Don Signor господин".split(),
    "f": "Mrs Ms Miss Frau Madame Mme Señora Sra Doña Signora госпожа".split(),
    "": "Dr Prof Professor Doctor Sir Dame".split(),
}
PARTICLES = "al bin da de del della den der des di do dos du el la le van von y zu".split()
_OF_NAME = {name: key for key, names in GIVEN.items() for name in names}
_OF_NAME |= {name.upper(): key for name, key in _OF_NAME.items()}

_PATTERN = re.compile(
    r"(?P<email>[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})"
    r"|(?<![\w:.])(?P<ipv6>(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:]|\.\d)"
    r"|(?<![\d.])(?P<ip>(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d))(?![\d]|\.\d)"
    r"|(?<![\w-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"
    r"|(?<![\w+])(?P<card>\d(?:[ -]?\d){12,18})(?![\w])"
    r"|(?<![\w])(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w])"
    r"|(?<![\w])(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![\w])"
)
# A word that begins like a name: an initial, or letters with hyphens and apostrophes; whether it has capitals is looked at later.
_PIECE = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
_BEGIN = "|".join(sorted((re.escape(x) for x in _OF_NAME), key=len, reverse=True))
_TITLE = "|".join(sorted((re.escape(x) for t in TITLES.values() for x in t), key=len, reverse=True))
_PARTICLE = "|".join(PARTICLES)
_NAME = re.compile(
    rf"(?<!\w)(?:(?P<title>{_TITLE})\.? +)?(?P<given>{_BEGIN})(?!\w)(?P<rest>(?: (?:(?:{_PARTICLE}) ){{0,2}}{_PIECE}(?!\w)){{1,3}})"
    rf"|(?<!\w)(?:(?:{_TITLE})\.? +)+(?!(?:{_TITLE})(?!\w))(?P<last>(?:(?:{_PARTICLE}) ){{0,2}}{_PIECE}(?!\w))"
)
_TITLED = re.compile(rf"(?<!\w)(?:{_TITLE})(?!\w)")
_DIGIT, _OTHER_DIGIT = re.compile(r"\d"), re.compile(r"[^\D0-9]")
_PLAIN_DIGITS = {n: str(unicodedata.decimal(chr(n))) for n in range(128, 0x110000) if chr(n).isdecimal()}
_WORD = re.compile(r"\w+")


def _name_span(m: re.Match) -> tuple[int, int] | None:
    """The name in a match, as far as its words are written like names; null if there is none."""
    if m["last"]:
        words = m["last"].split(" ")
        return m.span("last") if words[-1][0].isupper() and len(words[-1]) > 1 else None
    end = m.start("rest")
    shout = m["given"].isupper() and len(m["given"]) > 1
    words = m["rest"][1:].split(" ")
    at = end
    for k, word in enumerate(words):
        at += 1 + len(word)
        if word in PARTICLES:
            continue
        # A third name follows only a short second one's pattern: names, not the next sentence.
        if not word[0].isupper() or (shout and not word.isupper()) or (len(word) < 2 and k == len(words) - 1):
            break
        end = at
        if word not in _OF_NAME:
            break  # a surname ends the name; given names may follow each other
    return (m.start("given"), end) if end > m.start("rest") else None


def find_entities(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the entities of a text, in order and without overlap.

    A name is a listed given name, in capitals or not, with further given names, particles and a surname, or a title's surname.
    """
    if not text:
        return []
    out = []
    if "@" in text or ":" in text or _DIGIT.search(text):
        # Digits of any script are found alike; each is one code point, so the spans hold for the text.
        plain = text if text.isascii() or not _OTHER_DIGIT.search(text) else text.translate(_PLAIN_DIGITS)
        out = [(m.lastgroup, *m.span()) for m in _PATTERN.finditer(plain)]
    if not _OF_NAME.keys().isdisjoint(_WORD.findall(text)) or _TITLED.search(text):
        taken = [(b, e) for _, b, e in out]
        m = _NAME.search(text)
        while m:
            span = _name_span(m)
            if span and not any(b < span[1] and span[0] < e for b, e in taken):
                out.append(("name", *span))
            # The words behind a name may begin the next one.
            m = _NAME.search(text, span[1] if span else m.end("given") if m["given"] else m.end())
        out.sort(key=lambda x: x[1])
    return out


def _parts_of(name: str) -> list[str]:
    """The words of a name that stand for a person by themselves."""
    return [w for w in name.split(" ") if len(w) > 1 and w not in PARTICLES]


def find_parts(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, name) of the parts of found names that stand alone elsewhere in the text."""
    whole: dict[str, str] = {}
    for kind, b, e in spans:
        if kind == "name":
            for part in _parts_of(text[b:e]):
                whole.setdefault(part, text[b:e])
    if not whole:
        return []
    alone = re.compile(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, whole), key=len, reverse=True)) + r")(?!\w)")
    out, k = [], 0
    for m in alone.finditer(text):
        while k < len(spans) and spans[k][2] <= m.start():
            k += 1
        if k == len(spans) or m.end() <= spans[k][1]:
            out.append((*m.span(), whole[m[0]]))
    return out


# -- permutation -----------------------------------------------------------------


class Permutation:
    """Keyed permutations of the numbers below a size, one for each tweak."""

    def __init__(self, key: str):
        self.key = key.encode()

    def _round(self, tweak: bytes, n: int, half: int, bits: int) -> int:
        data = tweak + bytes([n]) + half.to_bytes((half.bit_length() + 8) // 8, "big")
        out, need = b"", (bits + 7) // 8
        while len(out) < need:
            out += hmac.digest(self.key, data + len(out).to_bytes(4, "big"), "sha256")
        return int.from_bytes(out[:need], "big") & ((1 << bits) - 1)

    def _walk(self, salt: bytes, value: int, size: int, rounds: range, back: bool) -> int:
        """A Feistel network, or its inverse, repeated until the number is in range."""
        low = (size - 1).bit_length() + 1 >> 1
        while True:
            left, right = value >> low, value & ((1 << low) - 1)
            for n in rounds:
                if back:
                    left, right = right ^ self._round(salt, n, left, low), left
                else:
                    left, right = right, left ^ self._round(salt, n, right, low)
            value = left << low | right
            if value < size:
                return value

    def __call__(self, tweak: str, value: int, size: int) -> int:
        """The next number on a secret circle through all of them, so never the number itself."""
        if size < 2:
            return value
        salt = hashlib.sha256(tweak.encode()).digest()
        place = self._walk(salt, value, size, range(8), False)
        return self._walk(salt, (place + 1) % size, size, range(7, -1, -1), True)


def _by_letters(permute: Permutation, tweak: str, text: str, alphabets: list[str | None]) -> str:
    """Exchange the characters that have an alphabet; the others stay and are part of the shape."""
    shape = "".join(c if a is None else f"\x00{a}" for c, a in zip(text, alphabets, strict=True))
    radices = [len(a) for a in alphabets if a]
    value = 0
    for c, a in zip(text, alphabets, strict=True):
        if a:
            value = value * len(a) + a.index(c)
    value = permute(tweak + shape, value, prod(radices))
    out = []
    for c, a in zip(reversed(text), reversed(alphabets), strict=True):
        if a:
            value, k = divmod(value, len(a))
            c = a[k]
        out.append(c)
    return "".join(reversed(out))


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _digits_like(c: str) -> str:
    """The ten digits of a digit's script; Unicode has them in a row."""
    zero = ord(c) - unicodedata.decimal(c)
    return "".join(map(chr, range(zero, zero + 10)))


def _alphabets(text: str) -> list[str | None]:
    return [_digits_like(c) if c.isdecimal() else next((a for a in (_LOWER, _UPPER) if c in a), None) for c in text]


def _luhn(digits: list[int]) -> int:
    """The check digit after these digits."""
    return -sum(d if i % 2 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10


def _mixed_ip(permute: Permutation, value: str) -> str:
    """An address in digits of several scripts: each number of as many digits, each place in its script."""
    parts = value.split(".")
    ranges = [((0, 10), (10, 90), (100, 156))[len(x) - 1] for x in parts]
    number = 0
    for x, (low, size) in zip(parts, ranges, strict=True):
        number = number * size + int(x) - low
    shape = "".join(c if c == "." else _digits_like(c) for c in value)
    number, out = permute("mixed ip" + shape, number, prod(size for _, size in ranges)), []
    for x, (low, size) in zip(reversed(parts), reversed(ranges), strict=True):
        number, k = divmod(number, size)
        out.append("".join(_digits_like(c)[int(d)] for c, d in zip(x, str(low + k), strict=True)))
    return ".".join(reversed(out))


def _iban_check(iban: str) -> str:
    """The check digits of an account number, whatever stands in their place."""
    number = "".join(str(int(c, 36)) for c in iban[4:] + iban[:2] + "00")
    return f"{98 - int(number) % 97:02}"


def _name_part(permute: Permutation, word: str) -> str:
    """The surrogate of one word of a name: a given name of the same gender and script, or letters of each letter's own kind."""
    if word in PARTICLES:
        return word
    if word in _OF_NAME:
        shout = word.isupper() and word.capitalize() != word
        script, gender = _OF_NAME[word]
        names = [x.upper() if shout else x for x in GIVEN[script, gender]]
        if word in names:
            return names[permute(f"given {script} {gender}", names.index(word), len(names))]
    alphabets = []
    for c in word:
        fit = next((a for kinds in LETTERS.values() for a in kinds if c.lower() in a), None)
        alphabets.append(fit.upper() if fit and c.isupper() else fit)
    return _by_letters(permute, "last", word, alphabets)


def surrogate(permute: Permutation, kind: str, value: str) -> str:
    """The surrogate of an entity: same kind, shape, script and gender; one-to-one for each kind."""
    if kind == "email":
        local, _, host = value.partition("@")
        name, _, top = host.rpartition(".")
        hosts = [None if c in ".-" else a for c, a in zip(name, _alphabets(name), strict=True)]
        return f"{_by_letters(permute, 'local', local, _alphabets(local))}@{_by_letters(permute, 'host', name, hosts)}.{top}"
    if kind == "ip":
        scripts = {_digits_like(c) for c in value if c != "."}
        if len(scripts) > 1:
            return _mixed_ip(permute, value)
        own = str.maketrans(_DIGITS, *scripts)
        parts = [int(x) for x in value.split(".")]
        number = int.from_bytes(bytes(parts), "big")
        usual = lambda n: 1 <= n >> 24 <= 223 and n >> 24 not in (10, 127)
        wanted = usual(number)
        while True:
            number = permute("ip", number, 1 << 32)
            if usual(number) == wanted:
                return ".".join(str(x) for x in number.to_bytes(4, "big")).translate(own)
    if kind == "name":
        return " ".join(_name_part(permute, w) for w in value.split(" "))
    if kind == "ipv6":
        groups, hexes = value.split(":"), "0123456789abcdef"
        hexes = hexes.upper() if value.upper() == value else hexes
        if any(c not in hexes + ":" for c in value):
            hexes = "0123456789abcdefABCDEF"
        head = groups[0] + ":"  # the network that the address belongs to
        rest = value[len(head) :]
        return head + _by_letters(permute, "ipv6" + head, rest, [None if c == ":" else hexes for c in rest])
    alphabets = _alphabets(value)
    places = [i for i, c in enumerate(value) if c.isdecimal()]
    if kind == "card":
        alphabets[places[0]] = None  # the issuer's digit
        digits = [int(value[i]) for i in places]
        if _luhn(digits[:-1]) == digits[-1]:
            body = value[: places[-1]]
            body = _by_letters(permute, "card with check digit", body, alphabets[: places[-1]])
            check = _digits_like(value[places[-1]])[_luhn([int(c) for c in body if c.isdecimal()])]
            return body + check + value[places[-1] + 1 :]
    if kind == "phone" and value[0] == "+":
        end = re.match(r"\+\d{1,3}(?=\D)|\+\d", value).end()
        alphabets[:end] = [None] * end  # the country
    if kind == "iban":
        alphabets[:2] = [None, None]
        plain = value.replace(" ", "")
        if _iban_check(plain) == plain[2:4] and value.isascii():
            alphabets[2:4] = [None, None]  # the check digits follow from the rest
            body = _by_letters(permute, "iban with check digits", value, alphabets)
            return body[:2] + _iban_check(body.replace(" ", "")) + body[4:]
    return _by_letters(permute, kind, value, alphabets)


# -- over documents --------------------------------------------------------------


def _surrogates(entities: DataFrame, key: str, source: str) -> DataFrame:
    """(kind, value, source, surrogate) with the surrogate of ``source``."""

    def start():
        permute = Permutation(key)

        def step(kinds, values):
            return [pa.array([surrogate(permute, k, v) for k, v in zip(kinds, values, strict=True)], pa.string())]

        return step

    return map_columns(entities, ["kind", source], "surrogate string", start)


def clashing(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) of the entities whose first surrogate is an entity as well.

    Each of them goes on along its circle to the next value that is neither an entity nor anybody's
    surrogate; of several that arrive at one value the smallest takes it and the others go on. Where the way comes back to the
    entity itself there is no free value, and the first surrogate stands. So all surrogates stay distinct.
    """
    known = entities.select(F.col("kind").alias("taken_kind"), F.col("value").alias("taken"))
    at = materialise(_surrogates(entities, key, "value"), "surrogates")
    occurs = lambda df, other, how: df.join(
        other, (df["kind"] == F.col("taken_kind")) & (df["surrogate"] == F.col("taken")), how
    )
    open_ = materialise(
        occurs(at, known, "left_semi").select("kind", "value", F.col("surrogate").alias("first"), "surrogate"), "clashes"
    )
    taken = known.unionByName(at.select(F.col("kind").alias("taken_kind"), F.col("surrogate").alias("taken")))
    done = at.limit(0).select("kind", "value", "surrogate")
    while not open_.isEmpty():
        moved = materialise(_surrogates(open_.withColumnRenamed("surrogate", "before"), key, "before").drop("before"), "clashes")
        closed = moved.where(F.col("surrogate") == F.col("value")).select("kind", "value", F.col("first").alias("surrogate"))
        going = moved.where(F.col("surrogate") != F.col("value"))
        free = occurs(going, taken, "left_anti").groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        free = materialise(free.select("kind", "value", "surrogate"), "clashes-solved")
        done = done.unionByName(closed).unionByName(free)
        taken = taken.unionByName(free.select(F.col("kind").alias("taken_kind"), F.col("surrogate").alias("taken")))
        solved = free.select(F.col("kind").alias("solved_kind"), F.col("value").alias("solved"))
        open_ = materialise(
            going.join(solved, (going["kind"] == F.col("solved_kind")) & (going["value"] == F.col("solved")), "left_anti"), "clashes"
        )
    return done


RESULTS = "surrogate_text string, entities array<struct<kind: string, start: bigint, end: bigint, surrogate: string>>"


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """Replace all personal data in whole texts by surrogates.

    Adds ``surrogate_text`` and ``entities`` (kind, start, end in code points of the old text, surrogate),
    replacing columns of these names; every row stays. Where a part of a name found in a text stands alone in it, it
    takes that part of the name's surrogate. The same ``key`` gives the same
    surrogates in any run and any table, but for those that clash with entities of this table. Null texts stay null,
    texts without entities stay as they are. Repeated rows are treated alike; rows without an id are replaced like others. An empty table gives an empty table.
    """
    docs = without(docs, ["surrogate_text", "entities"])

    def finder():
        kind = pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())]))

        def step(texts):
            found = [{(k, t[b:e]) for k, b, e in find_entities(t)} for t in texts]
            return [pa.array([[{"kind": k, "value": v} for k, v in sorted(x)] for x in found], kind)]

        return step

    ids = docs.select(F.col("doc_id").alias("mention_doc"), "text")
    mentions = map_columns(ids, ["text"], "found array<struct<kind: string, value: string>>", finder)
    mentions = materialise(mentions.select("mention_doc", F.inline("found")), "mentions")
    clashes = clashing(materialise(mentions.select("kind", "value").distinct(), "entities"), key)
    doc, own = free_names(docs, "clash_doc", "clash_list")
    special = materialise(
        mentions.join(clashes, ["kind", "value"])
        .groupBy(F.col("mention_doc").alias(doc))
        .agg(F.collect_set(F.struct("kind", "value", "surrogate")).alias(own)),
        "clashes-by-document",
    )
    joined = docs.join(special, F.col("doc_id").eqNullSafe(F.col(doc)), "left").drop(doc)

    def replacer():
        permute = Permutation(key)
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("surrogate", pa.string())])
        )

        def one(text, clashes):
            spans = find_entities(text)
            if not spans:
                return text, []
            other = {(c["kind"], c["value"]): c["surrogate"] for c in clashes or []}

            def new_of(k: str, value: str) -> str:
                return other.get((k, value)) or surrogate(permute, k, value)

            new = [(b, e, k, new_of(k, text[b:e])) for k, b, e in spans]
            for b, e, name in find_parts(text, spans):
                # A part of a name takes the same part of its surrogate: both have as many words.
                words = dict(zip(name.split(" "), new_of("name", name).split(" "), strict=True))
                new.append((b, e, "name", words[text[b:e]]))
            out, entities, done = [], [], 0
            for b, e, k, new in sorted(new):
                out += [text[done:b], new]
                entities.append({"kind": k, "start": b, "end": e, "surrogate": new})
                done = e
            return "".join([*out, text[done:]]), entities

        def step(texts, clashes):
            rows = [one(t, c) for t, c in zip(texts, clashes, strict=True)]
            return [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], kind)]

        return step

    return map_columns(joined, ["text", own], RESULTS, replacer).drop(own)
