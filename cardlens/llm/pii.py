"""Personal data: detected entities get keyed surrogates of the same type and format.

Detected are e-mail addresses, phone numbers, payment card numbers (Luhn), IPv4 addresses,
secrets (``password=...``, ``token = "..."``) and personal names after a title. A surrogate is
drawn with a keyed hash (HMAC-SHA-256) of the entity and keeps what can be seen of it: script,
letter case, digit groups and punctuation, the card's issuer digit and Luhn sum, a valid address,
a name of the title's gender in the script of the original.

The same entity gets the same surrogate in every document (coreference), so no table of all
entities travels: a surrogate is a function of key and entity. Given names, family names and mail
domains are entities of their own, so a person keeps one family name with and without the given name, and
a family name that stands after a title is replaced wherever else it stands in the same document. Collision checks over all distinct
entities of the corpus find those whose surrogate equals another entity's surrogate or a real
entity; all but one of them draw again until none collide (distinctness). The space of values grows
with the draws (more syllables, longer local parts, more digits), so there is always room. Only the
entities that drew again are looked up when texts are rewritten.
"""

from __future__ import annotations

import hashlib
import hmac
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm.common import as_bytes, column_or, materialise, ready, table

#: Redrawn entities that are broadcast at most (some 100 bytes each); more are joined per text.
MAX_BROADCAST = 200_000
#: Redraws that keep the length of a number or secret; each further one adds a digit or letter.
SAME_LENGTH = 4

# Given names and family names that surrogates are composed of, by script and gender.
NAMES = {
    ("latin", "f"): ["Anna", "Clara", "Elena", "Emma", "Julia", "Laura", "Maria", "Nora", "Paula", "Sofia"],
    ("latin", "m"): ["Adam", "Bruno", "David", "Felix", "Hugo", "Jonas", "Leon", "Martin", "Oscar", "Simon"],
    ("cyrillic", "f"): ["Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Татьяна"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Иван", "Максим", "Олег", "Павел", "Роман"],
    ("greek", "f"): ["Άννα", "Ελένη", "Ειρήνη", "Μαρία", "Σοφία", "Δήμητρα"],
    ("greek", "m"): ["Γιάννης", "Κώστας", "Νίκος", "Πέτρος", "Σπύρος", "Ανδρέας"],
}
SYLLABLES = {
    "latin": ["ba", "der", "fin", "gar", "hol", "ker", "lan", "mor", "ner", "per", "ros", "sten", "tal", "vin", "wes"],
    "cyrillic": ["бе", "вол", "гор", "дан", "ков", "лен", "мор", "нов", "пет", "сав", "тар", "рин"],
    "greek": ["βα", "δη", "κο", "λα", "μα", "νι", "πα", "ρο", "σα", "τα", "φι", "θε"],
}
TITLES = {"Mr": "m", "Mr.": "m", "Herr": "m", "Señor": "m", "Sr.": "m", "Monsieur": "m", "Господин": "m", "Κύριος": "m",
          "Mrs": "f", "Mrs.": "f", "Ms": "f", "Ms.": "f", "Frau": "f", "Señora": "f", "Sra.": "f", "Madame": "f",
          "Mme": "f", "Госпожа": "f", "Κυρία": "f"}

_NAME_WORD = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
_PATTERN = re.compile("|".join((
    r"(?P<email>[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.)+[A-Za-z]{2,24})",
    r"(?P<secret>(?i:(?P<word>password|passwd|pwd)|secret|token|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3}(?P<quote>[\"'])?"
    r"(?P<value>[A-Za-z0-9+/_\-]{8,}))",
    r"(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))",
    r"(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d))",
    r"(?P<card>(?:(?<![\w.+-])|(?<=\d-))\d(?:[ -]?\d){12,18}(?!\w|\.\d))",
    r"(?P<name>(?<!\w)(?P<title>" + "|".join(re.escape(t) for t in sorted(TITLES, key=len, reverse=True)) + r")"
    r" (?P<person>" + _NAME_WORD + r"(?: " + _NAME_WORD + r")?))",
)))
# a cheap look before the full pattern: no entity is without one of these
_HINT = re.compile(r"@|\d[ .-]?\d[ .()-]{0,2}\d|[=:]|" + "|".join(re.escape(t) for t in TITLES))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _card(run: str) -> str | None:
    """The longest start of a run of digit groups that ends with a group, has 13 digits or more and the Luhn sum."""
    for end in (len(run), *(m.start() for m in reversed(list(re.finditer("[ -]", run))))):
        digits = re.sub(r"\D", "", run[:end])
        if len(digits) < 13:
            return None
        if len(set(digits)) > 1 and luhn(digits):
            return run[:end]
    return None


def detect(text: str | None):
    """(start, end, type, entity) of every entity, left to right, without overlaps."""
    if not text or not _HINT.search(text):
        return
    at = 0
    while m := _PATTERN.search(text, at):
        at = m.end()
        kind = m.lastgroup if m.lastgroup in ("email", "ip", "phone", "card") else None
        if m.group("secret"):
            value = m.group("value")
            if m.group("word") or m.group("quote") or any(c.isdigit() for c in value):
                yield m.start("value"), m.end("value"), "secret", value
            else:
                at = m.start("value")  # it may hold another entity
        elif m.group("name"):
            words = m.group("person").split(" ")
            named = [w for w in words if w[0].isupper() and len(w) > 1]
            if named and words[0] == named[0]:
                person = " ".join(named[:2] if words == named else named[:1])
                start = m.start("person")
                yield start, start + len(person), "name-" + TITLES[m.group("title")], person
        elif kind == "card":
            run = m.group()
            if card := _card(run):
                at = m.start() + len(card)
                yield m.start(), at, kind, card
            else:  # a card or another number may begin with the next group
                at = m.start() + len(re.match(r"\d+", run).group())
        elif kind:
            yield m.start(), m.end(), kind, m.group()


def canonical(kind: str, entity: str) -> str:
    """What counts as the same entity: case of addresses and separators of numbers do not."""
    if kind == "email":
        return entity.lower()
    if kind in ("phone", "card"):
        return re.sub(r"\D", "", entity)
    return entity


def parts(kind: str, entity: str) -> list[tuple[str, str]]:
    """The (kind, canonical entity) pairs that get surrogates of their own in a detected entity."""
    if kind == "email":
        return [("email", entity.lower()), ("domain", entity.lower().partition("@")[2])]
    if kind.startswith("name-"):
        *given, family = (_as_name(w) for w in entity.split(" "))
        return [*(("given-" + kind[-1], g) for g in given), ("family", family)]
    return [(kind, canonical(kind, entity))]


def _as_name(word: str) -> str:
    """A name in capitals is the same name."""
    return "".join(x.capitalize() for x in re.split("(['’-])", word)) if word.isupper() else word


class _Stream:
    """Numbers below a bound from an HMAC in counter mode."""

    def __init__(self, key: bytes, message: str):
        self.key, self.message, self.n, self.held = key, message.encode("utf-8", "surrogatepass"), 0, []

    def below(self, n: int) -> int:
        if not self.held:
            block = hmac.new(self.key, self.message + b"\0%d" % self.n, hashlib.sha256).digest()
            self.held = [int.from_bytes(block[i:i + 4], "big") for i in range(0, 32, 4)]
            self.n += 1
        return self.held.pop() * n >> 32


def _like(s: _Stream, text: str) -> str:
    """Letters for letters of the same case, digits for digits, all else as it is."""
    out = []
    for c in text:
        if c.isdigit():
            out.append("0123456789"[s.below(10)])
        elif "a" <= c <= "z":
            out.append(chr(97 + s.below(26)))
        elif "A" <= c <= "Z":
            out.append(chr(65 + s.below(26)))
        else:
            out.append(c)
    return "".join(out)


def _hexlike(s: _Stream, text: str) -> str:
    if re.fullmatch(r"[0-9a-f]+", text):
        return "".join("0123456789abcdef"[s.below(16)] for _ in text)
    return _like(s, text)


def _script(word: str) -> str:
    c = ord(word[0])
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 else "latin"


def surrogate(key: bytes, kind: str, entity: str, draw: int = 0) -> str:
    """The canonical surrogate of a canonical entity; its space grows with the draws."""
    s = _Stream(key, f"{kind}\0{draw}\0{entity}")
    more = max(0, draw - SAME_LENGTH)
    if kind == "email":  # the domain is replaced by its own surrogate
        local, _, domain = entity.partition("@")
        return f"{_like(s, local + 'x' * draw)}@{domain}"
    if kind == "domain":
        host, _, top = entity.rpartition(".")
        return f"{_like(s, host + 'x' * draw)}.{top}"
    if kind == "ip" and more:  # IPv4 is full: a unique local IPv6 address
        return "fd%02x:" % s.below(256) + ":".join("%x" % s.below(1 << 16) for _ in range(7))
    if kind == "ip":
        parts = [s.below(223) + 1, s.below(256), s.below(256), s.below(254) + 1]
        return ".".join(map(str, parts))
    if kind == "phone":
        keep = len(entity) - 10 if len(entity) > 10 else 1  # the country code
        body = [str(2 + s.below(8))] + [str(s.below(10)) for _ in range(len(entity) - keep - 1 + more)]
        return entity[:keep] + "".join(body)
    if kind == "card":
        body = entity[0] + "".join(str(s.below(10)) for _ in range(len(entity) - 2 + more))
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    if kind == "secret":
        return _hexlike(s, entity + ("a" if re.fullmatch(r"[0-9a-f]+", entity) else "x") * more)
    pool = SYLLABLES[_script(entity)]

    def syllables(n: int) -> str:
        return "".join(pool[s.below(len(pool))] for _ in range(n))

    if kind.startswith("given-"):
        names = NAMES[_script(entity), kind[-1]]
        return names[s.below(len(names))] + syllables(draw)
    # every part of a hyphenated name is replaced; single letters (O') stay
    return "".join(syllables(3 + draw).capitalize() if len(x) > 1 else x for x in re.split("(['’-])", entity))


def render(kind: str, entity: str, new: str) -> str:
    """The canonical surrogate in the format of the entity as it was written."""
    if kind in ("phone", "card"):
        digits = iter(new)
        return "".join(next(digits) if c.isdigit() else c for c in entity) + "".join(digits)
    if kind == "email" and entity != entity.lower():
        return new.upper() if entity == entity.upper() else new
    return new


def rewrite(text: str | None, key: bytes, draws: dict[tuple[str, str], int], drawn=surrogate) -> tuple[str | None, int]:
    """The text with surrogates for its entities, and how many were replaced."""
    def new(kind: str, name: str) -> str:
        return drawn(key, kind, name, draws.get((kind, name), 0))

    out, at, n, families = [], 0, 0, set()
    for start, end, kind, entity in detect(text):
        found = [new(*x) for x in parts(kind, entity)]
        if kind == "email":
            value = render(kind, entity, f"{found[0].partition('@')[0]}@{found[1]}")
        elif kind.startswith("name-"):
            families.add(parts(kind, entity)[-1][1])
            value = " ".join(x.upper() if w.isupper() else x for w, x in zip(entity.split(" "), found, strict=True))
        else:
            value = render(kind, entity, found[0])
        out += [text[at:start], value]
        at, n = end, n + 1
    if not n:
        return text, 0
    out.append(text[at:])
    if families:
        forms = sorted({f for x in families for f in (x, x.upper())}, key=len, reverse=True)
        bare = re.compile(r"(?<![\w'’-])(?:" + "|".join(map(re.escape, forms)) + r")(?![\w-]|['’]\w\w)")
        for i in range(0, len(out), 2):  # what lies between the entities
            out[i], more = bare.subn(lambda m: new("family", _as_name(m.group())).upper() if m.group().isupper()
                                     else new("family", m.group()), out[i])
            n += more
    return "".join(out), n


def _entities(docs: DataFrame) -> DataFrame:
    """kind, entity (canonical): one row for each distinct pair of a batch."""

    def run(batches):
        for batch in batches:
            found = {x for t in batch.column("text").to_pylist() for _, _, k, e in detect(t) for x in parts(k, e)}
            rows = sorted(found)
            yield pa.RecordBatch.from_pydict({"kind": pa.array([k for k, _ in rows], pa.string()),
                                              "entity": pa.array([e for _, e in rows], pa.string())})

    return docs.select("text").mapInArrow(run, "kind string, entity string")


def _drawn(entities: DataFrame, key: bytes, drawn=surrogate) -> DataFrame:
    """kind, entity, draw plus ``new``, the surrogate of that draw."""

    @F.arrow_udf("string")
    def new(kind: pa.Array, entity: pa.Array, draw: pa.Array) -> pa.Array:
        rows = zip(kind.to_pylist(), entity.to_pylist(), draw.to_pylist(), strict=True)
        return pa.array([drawn(key, k, e, d) for k, e, d in rows], pa.string())

    return entities.withColumn("new", new("kind", "entity", "draw"))


def resolve(docs: DataFrame, key: bytes, drawn=surrogate) -> DataFrame:
    """kind, entity, draw of the entities that had to draw again (draw > 0).

    ``drawn(key, kind, entity, draw)`` makes the surrogates.

    Ends for any number of entities: each round's draws come from a space at least ten times as large.
    """
    distinct = materialise(_entities(docs).distinct().withColumn("draw", F.lit(0)), "pii-entities")
    current = materialise(_drawn(distinct, key, drawn), "pii-drawn")
    real = distinct.select("kind", F.col("entity").alias("new"), F.lit(True).alias("real"))
    while True:
        # given names of both genders share one space, so a surrogate never stands for two names
        space = F.substring_index("kind", "-", 1)
        # the entity that has drawn most often, then the smallest, keeps a disputed surrogate
        first = current.groupBy(space.alias("space"), "new").agg(
            F.count("*").alias("c"), F.max(F.struct("draw", "kind", "entity")).alias("keeps"))
        disputed = materialise(first.where("c > 1"), "pii-disputed")
        taken = real.select(F.substring_index("kind", "-", 1).alias("space"), "new", "real").distinct()
        again = (current.withColumn("space", space).join(disputed, ["space", "new"], "left")
                 .join(taken, ["space", "new"], "left")
                 .withColumn("again", F.coalesce(
                     (F.col("keeps.kind") != F.col("kind")) | (F.col("keeps.entity") != F.col("entity")),
                     F.lit(False)) | F.coalesce("real", F.lit(False))))
        again = materialise(again.select("kind", "entity", "draw", "new", "again"), "pii-again")
        if again.where("again").isEmpty():
            return current.where("draw > 0").select("kind", "entity", "draw")
        current = materialise(
            again.where("NOT again").drop("again").union(
                _drawn(again.where("again").select("kind", "entity", (F.col("draw") + 1).alias("draw")), key, drawn)),
            "pii-drawn")


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """All columns of ``docs``; ``text`` with surrogates, plus ``_entities``, the number replaced.

    Texts without entities, NULL and empty texts stay as they are. Repeated rows are rewritten alike;
    an empty table stays empty.
    """
    ready(docs.sparkSession)
    raw = key.encode()
    text = docs.withColumn("text", column_or(docs, "text", "string"))
    again = materialise(resolve(text, raw), "pii-redrawn")
    names = [F.col(f"`{c}`") for c in docs.columns]
    if again.count() <= MAX_BROADCAST:
        draws = {(r.kind, r.entity): r.draw for r in again.collect()}
        shared = docs.sparkSession.sparkContext.broadcast(draws)
        fixed = text.withColumn("_done", _rewriter(raw, shared)("text", F.lit(None).cast(_DRAWS)))
    else:
        # each text brings its own redrawn entities: (text, entity) pairs meet the table, then the text
        key_of = F.sha2(F.col("text"), 256)
        pairs = (_text_entities(text.select(key_of.alias("_key"), "text").where("text IS NOT NULL"))
                 .distinct().join(again, ["kind", "entity"]))
        own = materialise(pairs.groupBy("_key").agg(F.collect_list(F.struct("kind", "entity", "draw")).alias("_draws")),
                          "pii-own")
        fixed = text.withColumn("_key", key_of).join(own, "_key", "left")
        none = docs.sparkSession.sparkContext.broadcast({})
        fixed = fixed.withColumn("_done", _rewriter(raw, none)("text", "_draws"))
    return fixed.withColumn("text", F.col("_done.text")).withColumn("_entities", F.col("_done.n")).select(*names, "_entities")


_DRAWS = "array<struct<kind:string,entity:string,draw:int>>"


def _rewriter(key: bytes, shared):
    @F.arrow_udf("text string, n long")
    def fix(text: pa.Array, own: pa.Array) -> pa.Array:
        done = []
        for t, draws in zip(text.to_pylist(), own.to_pylist(), strict=True):
            mine = {(d["kind"], d["entity"]): d["draw"] for d in draws} if draws else shared.value
            done.append(rewrite(t, key, mine))
        return pa.StructArray.from_arrays([pa.array([t for t, _ in done], pa.string()),
                                           pa.array([n for _, n in done], pa.int64())], ["text", "n"])
    return fix


def _text_entities(rows: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            out = [(k, *x)
                   for k, t in zip(batch.column("_key").to_pylist(), batch.column("text").to_pylist(), strict=True)
                   for _, _, kind, e in detect(t) for x in parts(kind, e)]
            yield pa.RecordBatch.from_pydict({c: pa.array([r[i] for r in out], pa.string())
                                              for i, c in enumerate(("_key", "kind", "entity"))})

    return rows.mapInArrow(run, "_key string, kind string, entity string")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents``, rewritten under a fixed demonstration key."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, "cardlens-demo-key").select("doc_id", "text", F.col("_entities").alias("n_entities"))
