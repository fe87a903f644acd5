"""Surrogates for personal data: keyed, type-consistent replacements.

Detected: e-mail addresses, telephone numbers, IPv4 addresses, card numbers (Luhn), IBANs (mod 97), US social security numbers,
secrets (access keys; values of password, token, secret, api_key), and person names after a title or a known given name; a
name that a text has once is found wherever that text has it again. Names that follow neither are not found.

A surrogate is made by a keyed hash of the kind, the normalised value and an attempt number, in the format of
the original: separators, lengths, case and check digits are kept; e-mails and IPs move to reserved ranges; name parts keep gender and script. The same
entity has the same surrogate in the whole corpus (coreference): telephone numbers with and without the North American +1
are one entity, and so is a given name whatever title it follows, whose gender all its mentions decide. Distinct entities get distinct surrogates,
none of them an entity of the corpus: the distinct entities are counted as a table, and those whose surrogate is taken, or is itself an entity, try again
until none collide; later attempts widen the space of values and in the end lengthen them, so a crowded or narrow format cannot run out.

The texts are scanned once: rows and their spans are written aside, and only mentions are shuffled. Entities with more than one
mention in HOT_SHARE are at most HOT_SHARE rows and are broadcast; the others meet their mentions in a join.

Defined cases: null and empty texts have no entity and stay as they are; repeated rows get the same text; overlapping
detections keep the one that starts first, then the longest; an empty table gives an empty result; other columns are kept,
unless a computed column (n_replaced, kinds) has their name.
"""

from __future__ import annotations

import hmac
import re
import string

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import discard, mapped, materialize, reads, table

KEY = "change-me"  # production passes its own
BROADCAST_BYTES = 8 << 20  # of all entities' values
HOT_SHARE = 2000

# Titles with the gender they tell, and given names by gender.
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "u", "Prof": "u", "Herr": "m", "Frau": "f", "Mme": "f", "Mlle": "f", "Señor": "m", "Señora": "f", "Г-н": "m", "Г-жа": "f"}
FEMALE = ("Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Susan", "Sarah", "Karen", "Anna", "Maria", "Laura", "Julia", "Sophie", "Marie", "Claire", "Carmen", "Lucía", "Ingrid", "Анна", "Мария", "Ольга", "Елена", "Наталья", "Ирина")
MALE = ("James", "John", "Robert", "Michael", "William", "David", "Richard", "Thomas", "Peter", "Paul", "Hans", "Jürgen", "Pierre", "Jean", "Carlos", "José", "Javier", "Klaus", "Иван", "Сергей", "Алексей", "Дмитрий", "Андрей", "Николай")
_GENDER = dict.fromkeys(FEMALE, "f") | dict.fromkeys(MALE, "m")

_NUMERIC = re.compile(
    r"""(?P<email>[A-Za-z0-9._%+\-]+@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,})
    |(?P<secret>(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|(?:(?<=password=)|(?<=password=")|(?<=token\ =\ ")|(?<=token=)|(?<=token=")|(?<=secret=)|(?<=secret=")|(?<=api_key=)|(?<=api_key="))[A-Za-z0-9_\-]{8,})
    |(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:\ ?[A-Z0-9]{4}){2,7}(?:\ ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
    |(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d))
    |(?P<phone>(?<![\w+])\+1[ .\-]?(?:\(\d{3}\)|\d{3})[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)|(?<![\w+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]\d{2,4}){2,4}(?!\d)(?!\.\d)|(?<![\w.])\(\d{3}\)\ \d{3}-\d{4}(?!\d)|(?<![\w.\-])\d{3}-\d{3}-\d{4}(?![\w\-]))
    |(?P<ssn>(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-]))
    |(?P<card>(?<![\w.])(?:\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{4}|\d{4}[ \-]\d{6}[ \-]\d{5}|\d{13,19})(?!\w))""",
    re.X,
)
_HINT = re.compile(r"[@0-9]|password=|token|secret=|api_key=|A[KS]IA")
_TITLE_HINT = tuple(t + s for t in TITLES for s in (". ", " "))
_CAP = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]+(?:[-'][A-ZÀ-ÖØ-ÞА-ЯЁ]?[a-zß-öø-ÿа-яё]+)?"
_TITLED = re.compile(r"(?<!\w)(" + "|".join(map(re.escape, TITLES)) + rf")\.? ({_CAP})(?: ({_CAP}))?(?!\w)")
_NAMED = re.compile(rf"(?<!\w)({'|'.join(map(re.escape, _GENDER))}) ({_CAP})(?!\w)")


def luhn(digits: str) -> bool:
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def iban_ok(value: str) -> bool:
    flat = value.replace(" ", "")
    return 15 <= len(flat) <= 34 and int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1


def detect(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind), in order, not overlapping."""
    if not text:
        return []
    found = []
    if _HINT.search(text):
        at = 0
        while m := _NUMERIC.search(text, at):
            kind, value, at = m.lastgroup, m.group(), m.start() + 1
            if kind == "iban":  # words in capitals may follow it
                while " " in value and not iban_ok(value):
                    value = value.rpartition(" ")[0]
            if kind == "card" and not luhn(re.sub(r"\D", "", value)) or kind == "iban" and not iban_ok(value):
                continue  # the search goes on within it
            at = m.start() + len(value)
            found.append((m.start(), at, kind))
    if any(t in text for t in _TITLE_HINT):
        for m in _TITLED.finditer(text):
            gender = TITLES[m.group(1)]
            if m.group(3):
                given = _GENDER.get(m.group(2), gender)
                found += [(*m.span(2), f"given-{given}"), (*m.span(3), "surname")]
            else:
                found.append((*m.span(2), "surname"))
    if not _GENDER.keys().isdisjoint(text.split()):
        for m in _NAMED.finditer(text):
            found += [(*m.span(1), f"given-{_GENDER[m.group(1)]}"), (*m.span(2), "surname")]
    names = {text[a:b]: kind for a, b, kind in sorted(found, reverse=True) if kind == "surname" or kind.startswith("given-")}
    if names:  # later mentions by one part of the name alone
        for m in re.finditer(rf"(?<!\w)(?:{'|'.join(sorted(map(re.escape, names), key=len, reverse=True))})(?!\w)", text):
            if len(m.group()) > 2:
                found.append((*m.span(), names[m.group()]))
    out: list[tuple[int, int, str]] = []
    for span in sorted(set(found), key=lambda s: (s[0], -s[1], s[2])):
        if not out or span[0] >= out[-1][1]:
            out.append(span)
    return out


def normal(kind: str, value: str) -> str:
    """What two mentions of one entity share."""
    if kind == "email":
        return value.lower()
    if kind in ("phone", "card", "ssn"):
        digits = re.sub(r"\D", "", value)
        return digits[1:] if kind == "phone" and len(digits) == 11 and digits[0] == "1" else digits
    if kind == "iban":
        return value.replace(" ", "")
    return value


class _Stream:
    """Numbers from a keyed hash."""

    def __init__(self, key: str, kind: str, value: str, attempt: int):
        self.key, self.seed, self.n, self.pool = key.encode(), f"{kind}\x00{value}\x00{attempt}\x00".encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 8:
            self.pool += hmac.digest(self.key, self.seed + str(self.n).encode(), "sha256")
            self.n += 1
        got, self.pool = int.from_bytes(self.pool[:8], "big"), self.pool[8:]
        return got % n

    def like(self, c: str) -> str:
        for group in (string.digits, string.ascii_lowercase, string.ascii_uppercase):
            if c in group:
                return group[self.below(len(group))]
        return c


_SYLLABLES = {"latin": ("ba", "be", "ca", "co", "da", "de", "fa", "ga", "ha", "jo", "ka", "la", "le", "ma", "mi", "na", "ni", "pa", "ra", "ro", "sa", "so", "ta", "va"), "cyrillic": ("ба", "ва", "га", "да", "жа", "за", "ка", "ла", "ма", "на", "па", "ра", "са", "та", "фа", "ше")}
_ENDS = {("latin", "f"): ("lia", "na", "ra", "tta"), ("latin", "m"): ("rd", "n", "s", "ld"), ("latin", "u"): ("ly", "ne"), ("cyrillic", "f"): ("ния", "ла"), ("cyrillic", "m"): ("мир", "н"), ("cyrillic", "u"): ("н",), ("latin", "surname"): ("son", "ford", "mann", "well", "ler"), ("cyrillic", "surname"): ("нов", "ров", "ков"), ("cyrillic", "surname-f"): ("нова", "рова", "кова")}


def surrogate(kind: str, value: str, key: str = KEY, attempt: int = 0) -> str:
    """For a normalised value; render() gives it the separators of a mention."""
    s = _Stream(key, kind, value, attempt)
    digits = lambda n: "".join(str(s.below(10)) for _ in range(n))
    more = max(0, attempt - 5)  # characters by which a value grows when its format is crowded
    if kind == "email":
        local, _, domain = value.rpartition("@")
        labels = domain.split(".")
        host = "".join(map(s.like, labels[0]))
        # under the reserved names; further letters tell more entities apart
        tld = labels[-1] if labels[-1] in ("com", "net", "org") else None
        end = ("example", tld) if tld else ("example",)
        return "".join(map(s.like, local)) + "".join(string.ascii_lowercase[s.below(26)] for _ in range(attempt)) + "@" + ".".join([host, *end])
    if kind == "ip":
        if more:  # the documentation prefix of the longer addresses
            return "2001:db8:" + ":".join(f"{s.below(1 << 16):x}" for _ in range(6))
        first = 10 if attempt < 2 else 240 + s.below(15)  # private, then reserved
        return f"{first}.{s.below(256)}.{s.below(256)}.{1 + s.below(254)}"
    if kind == "card":
        body = value[0] + digits(len(value) - 2 + more)
        return next(body + c for c in string.digits if luhn(body + c))
    if kind == "phone":
        if len(value) == 10 and value[0] not in "01":  # North American form: area and exchange begin with 2 to 9, 555 is kept while it can
            exchange = "555" if value[3:6] == "555" and attempt < 3 else f"{2 + s.below(8)}{digits(2)}"
            return f"{2 + s.below(8)}{digits(2)}{exchange}{digits(4 + more)}"
        return value[:2] + digits(len(value) - 2 + more)
    if kind == "ssn":
        return "9" + digits(8 + more)
    if kind == "iban":
        body = "".join(map(s.like, value[4:])) + digits(more)
        rest = int("".join(str(int(c, 36)) for c in body + value[:2] + "00")) % 97
        return f"{value[:2]}{98 - rest:02d}{body}"
    if kind == "secret":
        fixed = 4 if value[:4] in ("AKIA", "ASIA") else 0
        tail = value[fixed:]
        hexadecimal = all(c in "0123456789abcdef" for c in tail)
        made = "".join("0123456789abcdef"[s.below(16)] if hexadecimal else s.like(c) for c in tail)
        if attempt > 1 or sum(c.isalnum() for c in tail) < 6:  # too few letters and digits to tell many apart: all characters change
            made = "".join((string.ascii_lowercase + string.digits)[s.below(36)] for _ in tail)
        return value[:fixed] + made + digits(more)
    script = "cyrillic" if re.search(r"[А-Яа-яЁё]", value) else "latin"
    ends = kind[6:] if kind.startswith("given-") else "surname-f" if script == "cyrillic" and value.endswith("а") else "surname"
    stem = "".join(_SYLLABLES[script][s.below(len(_SYLLABLES[script]))] for _ in range(2 + min(attempt, 6)))
    last = _ENDS[script, ends]
    return (stem + last[s.below(len(last))]).capitalize()


def render(kind: str, mention: str, made: str) -> str:
    """The surrogate with the separators, the country code 1 or the case of the mention."""
    if kind in ("phone", "card", "ssn", "iban"):
        given = re.sub(r"[^0-9A-Za-z]", "", mention)
        chars = iter(given[: len(given) - len(normal(kind, mention))] + made)
        return "".join([next(chars, "") if c.isalnum() else c for c in mention] + list(chars))
    if kind == "email":
        local, _, domain = mention.rpartition("@")
        new, _, host = made.rpartition("@")
        cased = "".join(c.upper() if i < len(local) and local[i].isupper() else c for i, c in enumerate(new))
        return f"{cased}@{host.upper() if domain.isupper() else host}"
    return made


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("gender", T.StringType()), T.StructField("value", T.StringType())]))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("gender", pa.string()), ("value", pa.string())]))


def _detected(batches):
    """(row, text) -> (row, text, spans)"""
    for batch in batches:
        found = []
        for t in batch.column(1):
            s = t.as_py()
            own = [(a, b, *k.partition("-")[::2]) for a, b, k in detect(s)]
            found.append([{"start": a, "end": b, "kind": k, "gender": g or None, "value": normal(k, s[a:b])} for a, b, k, g in own])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _ARROW_SPANS)], ["row", "text", "spans"])


def _made(key: str):
    def run(batches):
        for batch in batches:
            kinds, values, genders, attempts = (batch.column(n).to_pylist() for n in ("kind", "value", "gender", "attempt"))
            made = [surrogate(f"given-{g}" if k == "given" else k, v, key, a) for k, v, g, a in zip(kinds, values, genders, attempts, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in ("kind", "value", "gender", "attempt")], pa.array(made, pa.string())], ["kind", "value", "gender", "attempt", "made"])

    return run


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, value, gender) of distinct entities -> with surrogates that are distinct and no entities themselves."""
    # given names and surnames share the space of names
    space = F.when(F.col("kind").isin("given", "surname"), F.lit("name")).otherwise(F.col("kind"))
    schema, own = "kind string, value string, gender string, attempt int, made string", ["kind", "value", "gender"]
    now = materialize(mapped(entities.select(*own, F.lit(0).alias("attempt")), _made(key), schema), "surrogates")
    values = entities.select(space.alias("space"), F.col("value").alias("made")).distinct()
    while True:  # values grow from the sixth attempt on, so this ends
        placed = now.withColumn("space", space)
        first = placed.groupBy("space", "made").agg(F.min(F.struct("attempt", "kind", "value")).alias("first"), F.count(F.lit(1)).alias("n"))
        # of entities that met in one surrogate the least keeps it, unless it is an entity's own value
        taken = first.join(values, ["space", "made"], "left_semi").select("space", "made", F.lit(True).alias("real"))
        bad = first.filter("n > 1").select("space", "made", "first").join(taken, ["space", "made"], "full")
        again = placed.join(bad, ["space", "made"]).filter(F.coalesce("real", F.lit(False)) | (F.col("first") != F.struct("attempt", "kind", "value"))).select(*own, (F.col("attempt") + 1).alias("attempt"))
        again = materialize(again.distinct(), "surrogates-again")
        if again.isEmpty():
            discard(again)
            return now
        kept = now.join(again.select("kind", "value"), ["kind", "value"], "left_anti").select(*now.columns)
        before, now = now, materialize(kept.union(mapped(again, _made(key), schema)), "surrogates")
        discard(before)
        discard(again)


def _rewritten(batches):
    """(row, text, found) -> (row, text, n_replaced, kinds)"""
    for batch in batches:
        texts, n, kinds = [], [], []
        for t, found in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
            s, out, at = t.as_py(), [], 0
            for f in found:
                out += [s[at : f["start"]], render(f["kind"], s[f["start"] : f["end"]], f["made"])]
                at = f["end"]
            texts.append("".join([*out, s[at:]]))
            n.append(len(found))
            kinds.append(",".join(sorted({f["kind"] for f in found})))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(n, pa.int64()), pa.array(kinds, pa.string())], ["row", "text", "n_replaced", "kinds"])


def replace(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """docs with the text rewritten, and n_replaced and kinds (sorted, comma-joined)."""
    names = [c for c in docs.columns if c.lower() not in {"n_replaced", "kinds"}]
    others = [c for c in names if c != text]
    # columns of the input stay in a struct, so that no name clashes
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in others] or [F.lit(0).alias("none")]).alias("row"), F.col(f"`{text}`").alias("text"))
    scanned = mapped(slim, _detected, T.StructType([*slim.schema.fields, T.StructField("spans", _SPANS)]))
    marked = materialize(scanned.select(F.monotonically_increasing_id().alias("uid"), "row", "text", "spans", F.size("spans").alias("n")), "pii-rows")
    mentions = marked.filter("n > 0").select("uid", F.explode("spans").alias("s")).select("uid", "s.*")
    sexes = F.when(F.min("gender").isin("m", "f") & (F.min("gender") == F.max(F.when(F.col("gender") != "u", F.col("gender")))), F.min("gender"))
    entities = materialize(mentions.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"), F.coalesce(sexes, F.lit("u")).alias("gender")), "pii-entities")
    chosen = assign(entities, key)
    size, total = entities.agg(F.coalesce(F.sum(F.length("value") + 32), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    on, m = ["kind", "value"], mentions.drop("gender")
    made = chosen.select(*on, "made")
    if size <= BROADCAST_BYTES:
        rendered = m.join(F.broadcast(made), on)
    else:  # an entity with a large share of all mentions is one of a few, which are broadcast
        hot = entities.filter(F.col("n") * HOT_SHARE > total).select(*on)
        rendered = m.join(F.broadcast(made.join(hot, on, "left_semi")), on).unionByName(m.join(F.broadcast(hot), on, "left_anti").join(made, on))
    per_row = rendered.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind", "made"))).alias("found"))
    joined = marked.filter("n > 0").select("uid", "row", "text").join(per_row, "uid").select("row", "text", "found")
    out_schema = T.StructType([*slim.schema.fields, T.StructField("n_replaced", T.LongType()), T.StructField("kinds", T.StringType())])
    plain = marked.filter("n = 0").select("row", "text", F.lit(0).cast("long").alias("n_replaced"), F.lit("").alias("kinds"))
    out = mapped(joined, _rewritten, out_schema).unionByName(plain)
    kept = [F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in names]
    return reads(out.select(*kept, "n_replaced", "kinds"), marked, entities, chosen)


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace(table(spark, sf_dir, "documents").select("doc_id", "text"))
