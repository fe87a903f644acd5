"""Language identification by compression.

Each language has a raw-content dictionary for zstandard, made of passages from a bounded sample of its labelled texts
(at most PER_LANG documents, PER_TEXT characters of each, at most DICT_BYTES of content); lines that languages share are left out. A text is encoded, whole and in pieces of PIECE
bytes, with each language's dictionary; the language with the smallest total wins. `margin` is by how much the
second smallest total exceeds it, as a share; a text without a letter, or with a margin below MIN_MARGIN, is rejected.

Defined cases: a null text or one without a letter is `und` with score 0, and rejected; without any labelled text
every prediction is `und`; ties go to the language with more training documents, then by code point; rows are
judged one by one, so repeated rows and ids agree; columns of the input are kept unless a computed column has
their name; an empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import Shared, discard, fold, mapped, materialize, ship, table

FOLDS, HELD_OUT = 4, 2
PER_LANG = 400
DICT_BYTES = 1 << 17
PER_TEXT, PASSAGE = 2048, 256  # characters of a text in the sample, and of a passage in a dictionary
PIECE = 1 << 12
LEVEL = 9
MIN_MATCH = 3  # bytes; syllables are short
MIN_MARGIN = 0.002
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")


def dictionary(texts: list[str], most: int = DICT_BYTES) -> bytes:
    """Raw content: passages of the texts, the first of each, then the second, and so on, each once, as long as they fit."""
    cut = [[t[i : i + PASSAGE].lower().encode() for i in range(0, len(t), PASSAGE)] for t in texts]
    out, size = {}, 0
    for nth in range(max(map(len, cut), default=0)):
        for passages in cut:
            if nth < len(passages) and passages[nth] not in out and size + len(passages[nth]) + 1 <= most:
                out[passages[nth]] = None
                size += len(passages[nth]) + 1
    return b" ".join([*reversed(out), b""])


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_lang: int = PER_LANG) -> list[tuple[str, bytes]]:
    """The languages of the labelled rows, the most frequent first, each with its dictionary."""
    t = F.col(f"`{text}`")
    labelled = docs.select(F.col(f"`{lang}`").alias("lang"), t.alias("text"), F.xxhash64(F.col(f"`{key}`"), t).alias("h")).filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}  # a row for each language
    if not counts:
        return []
    u = F.pmod("h", F.lit(1 << 20))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1 << 20, 1 + (2 * per_lang << 20) // n))])

    def content(key, found):
        texts = [t for _, t in sorted(zip(found.column("nth").to_pylist(), found.column("text").to_pylist(), strict=True))]
        return pa.table({"lang": [key[0].as_py()], "content": pa.array([dictionary(texts)], pa.binary())})

    def dictionaries(rows: DataFrame) -> dict[str, bytes]:
        # PER_TEXT characters from some place of each text: a sample bounded by rows and bytes
        place = F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - PER_TEXT + 1, F.lit(1)))
        few = rows.select("lang", u.alias("u"), F.substring(F.col("text"), (place + 1).cast("int"), F.lit(PER_TEXT)).alias("text"))
        # a task hands on at most that many rows of a language, however often a row is repeated
        few = few.withColumn("nth", F.row_number().over(W.partitionBy("lang").orderBy("u", "text"))).filter(F.col("nth") <= per_lang)
        few = sample = materialize(few.select("lang", "nth", "text"), "language-sample")
        # lines that the samples of several languages share tell nothing of a language
        lines = few.select("lang", "nth", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        common = lines.groupBy("line").agg(F.min("lang").alias("a"), F.max("lang").alias("b")).filter("a <> b").select("line")
        kept = lines.join(common, "line", "left_anti").groupBy("lang", "nth").agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("x"))
        few = kept.select("lang", "nth", F.array_join(F.col("x.line"), "\n").alias("text"))
        found = {r[0]: bytes(r[1]) for r in few.groupBy("lang").applyInArrow(content, "lang string, content binary").collect()}
        discard(sample)
        return found

    ship(docs.sparkSession)
    made = dictionaries(labelled.filter(u < share[F.col("lang")]))
    rest = sorted(counts.keys() - made.keys())
    if rest:  # a language of few different rows, of which the share has none
        made |= dictionaries(labelled.filter(F.col("lang").isin(rest)))
    return sorted(made.items(), key=lambda x: (-counts[x[0]], x[0]))


class Judge:
    def __init__(self, model: list[tuple[str, bytes]]):
        self.langs = [k for k, _ in model]
        self.compress = []
        for _, content in model:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters.from_level(LEVEL, min_match=MIN_MATCH, write_content_size=False, write_checksum=False)
            d.precompute_compress(compression_params=how)
            self.compress.append(zstandard.ZstdCompressor(compression_params=how, dict_data=d).compress)

    def sizes(self, text: str) -> list[int]:
        data = (" " + text.lower()).encode()
        pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        return [sum(len(c(p)) for p in pieces) for c in self.compress]

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """Language, score from 0 to 1, margin."""
        if not text or not self.langs or _LETTER.search(text) is None:
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=sizes.__getitem__)
        best = sizes[order[0]]
        margin = (sizes[order[1]] - best) / best if len(order) > 1 else 1.0
        return self.langs[order[0]], min(1.0, 0.5 + 0.5 * min(1.0, margin * 10)), margin


def identify(docs: DataFrame, model: list[tuple[str, bytes]], text: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """docs with lang_pred, score, margin and rejected; the model's size is bounded by its languages."""
    shared = Shared(docs.sparkSession, model)
    made = ["lang_pred", "score", "margin", "rejected"]
    kept = [c for c in docs.columns if c.lower() not in made]
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("margin", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def judged(batches):
        judge = shared.built(Judge)
        for batch in batches:
            found = [judge(t.as_py()) for t in batch.column(text)]
            lang, score, margin = (list(x) for x in zip(*found, strict=True)) if found else ([], [], [])
            rejected = [k == UNKNOWN or m < min_margin for k, m in zip(lang, margin, strict=True)]
            columns = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *columns], [*kept, *made])

    return mapped(docs.select(*[F.col(f"`{c}`") for c in kept]), judged, schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.filter(fold("doc_id", FOLDS) != HELD_OUT))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score", "margin", "rejected")
