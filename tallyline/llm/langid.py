"""Language identification by compression against per-language zstandard dictionaries.

A dictionary is raw content: passages of labelled texts of one language, joined. A text is compressed whole, in
lower case, with each dictionary and goes to the language whose result is smallest. The model is a few hundred KB per language, taken from a
bounded sample of labelled rows; every text of the table is scored in its task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from tallyline.llm import blocks

PASSAGES = 1000       # labelled texts per language in a dictionary, at most
PASSAGE_CHARS = 400   # of each
LANGUAGES = 400       # dictionaries, at most; labels beyond that raise an error
LEVEL = 6
MARGIN = 0.004        # smallest relative gap in size between the best two languages that is accepted
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def fit(labelled: DataFrame, passages: int = PASSAGES, chars: int = PASSAGE_CHARS) -> dict[str, bytes]:
    """One dictionary for every language of ``labelled(text, lang)``; rows without text or language teach nothing.

    Texts are sampled by a hash of the text, so copies count once, and a passage starts at a hashed place. The sample holds
    at most ``passages`` texts per language; ranking stops at that number before the shuffle.
    """
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL AND length(text) > 0").select("lang", "text")
    known = rows.groupBy("lang").count().limit(LANGUAGES + 1).collect()
    if len(known) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not known:
        return {}
    share = F.element_at(F.create_map(*[F.lit(x) for r in known for x in (r["lang"], min(1.0, 20 * passages / r["count"]))]), F.col("lang"))
    code = F.xxhash64("text")
    start = F.pmod(F.xxhash64("_code"), F.greatest(F.length("text") - chars, F.lit(1))).cast("int") + 1
    part = (rows.withColumn("_code", code).filter(F.pmod("_code", F.lit(1_000_000)) < share * 1_000_000)
                .select("lang", "_code", F.substring("text", start, F.lit(chars)).alias("passage"))
                .groupBy("lang", "_code").agg(F.min("passage").alias("passage")))
    best = F.row_number().over(Window.partitionBy("lang").orderBy("_code"))
    sample = part.withColumn("_place", best).filter(F.col("_place") <= passages)
    found: dict[str, list[tuple[int, str]]] = {r["lang"]: [] for r in known}
    for r in sample.collect():
        found[r["lang"]].append((r["_code"], r["passage"]))
    return {lang: "\n".join(p for _, p in sorted(some)).lower().encode() for lang, some in sorted(found.items()) if some}


def classify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN, level: int = LEVEL) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``accepted``; columns of these names are replaced.

    ``lang_pred`` is the language with the smallest result, ties to the first name; ``und`` with score 0 for a null text, one
    without a letter, and where nothing was learned. ``score`` (0 to 1) is the share of the best language if every byte saved
    halved the odds of the others. ``accepted`` is false for ``und`` and where the gap between the best two sizes is below
    ``margin`` of the second, that is, where margins are narrow; one known language leaves no gap to judge. What a dictionary
    saves is bounded, so a size beyond that of the largest compressed dictionary asks for no wider gap.
    """
    import zstandard

    evidence = max((len(zstandard.ZstdCompressor(level=level).compress(c)) for c in dictionaries.values()), default=0)
    held = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import zstandard as zstd

        names, coders = list(held.value), []
        for content in held.value.values():
            own = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=level)
            coders.append(zstd.ZstdCompressor(dict_data=own, write_checksum=False, write_content_size=False, write_dict_id=False))
        for column in columns:
            found, odds, clear = [], [], []
            for text in column:
                text = text.as_py()
                if not text or not names or not _LETTER.search(text):
                    found.append(UNKNOWN)
                    odds.append(0.0)
                    clear.append(False)
                    continue
                raw = text.lower().encode()
                sizes = np.array([len(c.compress(raw)) for c in coders])
                order = np.argsort(sizes, kind="stable")
                best = sizes[order[0]]
                found.append(names[order[0]])
                odds.append(float(1 / np.exp2(np.maximum(best - sizes, -1000).astype(float)).sum()))
                clear.append(bool(len(sizes) == 1 or sizes[order[1]] - best >= max(1.0, margin * min(sizes[order[1]], evidence))))
            yield pa.StructArray.from_arrays(
                [pa.array(found, pa.string()), pa.array(odds, pa.float64()), pa.array(clear, pa.bool_())], ["lang_pred", "score", "accepted"])

    once = F.arrow_udf(blocks.returning(run), "lang_pred string, score double, accepted boolean", ArrowUDFType.SCALAR_ITER).asNondeterministic()
    rows = docs.drop("lang_pred", "score", "accepted")
    made = rows.select(F.struct("*").alias("_row"), once("text").alias("_found"))
    return made.select("_row.*", "_found.*")
