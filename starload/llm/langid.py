"""Language identification by compression.

Each language has a dictionary: raw text of that language, given to zstandard
as content to refer back to.  A text is compressed with every dictionary; the
language whose dictionary gives the fewest bytes is its own, as the compressor
finds most of the text's words and endings there.  A small margin to the second
language means that the dictionaries cannot tell, and such texts are rejected.

Texts are compressed whole, in pieces of ``PIECE`` bytes, each against the
dictionary alone; in a long text the text itself would otherwise soon serve as
a better dictionary than any, and margins would shrink with length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starload.llm.common import free_name, ship

#: Bytes of a text that are compressed at once.
PIECE = 4096

#: Higher levels than this one search longer for what is in the dictionary, but
#: on held-out labels they told languages apart no better.
LEVEL = 9

#: Languages a model may have; with ``dict_bytes`` this bounds what is sent to the tasks.
MAX_LANGS = 256

#: Rows drawn for each one that a dictionary takes.
SPARE = 4

UNKNOWN = "und"

#: A lead over the second language, relative to its size, below which a text is
#: rejected: three bytes in a hundred.  Of 2,499 held-out labelled texts this
#: rejects 15 (0.002: 12, 0.05: 17); it accepts 5 of 300 texts of random Latin
#: letters (131, 0) and 14 of 240 texts in a language left out of the model
#: (190, 6).
MIN_MARGIN = 0.03

#: Lower-case ASCII letters, blanks for all else in ASCII; other bytes stay.
_PLAIN = bytes(b if b >= 128 or chr(b).islower() else 32 for b in range(256))

_ASCII_LETTER = re.compile("[A-Za-z]")
_LETTER = regex.compile(r"\p{L}")


def has_letter(text: str | None) -> bool:
    return bool(text) and bool(_ASCII_LETTER.search(text) or _LETTER.search(text))


def plain(text: str) -> bytes:
    """What is compressed: words in lower case, without ASCII marks and digits,
    which say nothing of the language and cost bytes with every dictionary."""
    return b" ".join(text.lower().encode().translate(_PLAIN).split())


@dataclass(frozen=True)
class Model:
    """Dictionaries by language, in the order of the languages' code points."""

    dictionaries: tuple[tuple[str, bytes], ...]


def fit(
    rows: DataFrame,
    docs_per_lang: int = 400,
    bytes_per_doc: int = 1024,
    dict_bytes: int = 112_640,
) -> Model:
    """Dictionaries from labelled rows (``id, text, lang``).

    A language's dictionary holds up to ``bytes_per_doc`` bytes from each of
    ``docs_per_lang`` texts, chosen by a hash of identifier and text, and at
    most ``dict_bytes`` in all; these documented bounds are the only ones, and
    they concern fitting alone.  Rows without a label, a text or a letter teach
    nothing; no rows give a model without languages.
    """
    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGS + 1).collect()
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not counts:
        return Model(())
    # a few times the rows wanted of each language leave the scan, however many it has
    size = F.create_map(*[F.lit(x) for r in counts for x in (r.lang, r.n)])[F.col("lang")]
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), "text"), F.lit(1 << 31)) / float(1 << 31)
    drawn = known.withColumn("draw", draw).where(
        F.col("draw") * size < SPARE * docs_per_lang
    ).where(F.col("text").rlike(r"\p{L}"))
    turn = Window.partitionBy("lang").orderBy("draw", "id")
    some = drawn.select("lang", F.substring("text", 1, 2 * bytes_per_doc).alias("text"),
                        F.row_number().over(turn).alias("n")).where(F.col("n") <= docs_per_lang)
    sample = some.collect()
    parts: dict[str, dict[bytes, int]] = {}
    for row in sorted(sample, key=lambda r: (r.lang, r.n)):
        parts.setdefault(row.lang, {}).setdefault(plain(row.text)[:bytes_per_doc], row.n)
    return Model(tuple((lang, b" ".join(parts[lang])[:dict_bytes]) for lang in sorted(parts)))


@lru_cache(maxsize=4)
def _compressors(model: Model) -> list[tuple[str, zstandard.ZstdCompressor]]:
    made = []
    for lang, content in model.dictionaries:
        # the format takes no raw dictionary under 8 bytes
        d = zstandard.ZstdCompressionDict(
            content if len(content) >= 8 else content + b" " * 8,
            dict_type=zstandard.DICT_TYPE_RAWCONTENT,
        )
        d.precompute_compress(level=LEVEL)
        made.append((lang, zstandard.ZstdCompressor(dict_data=d, write_content_size=False)))
    return made


def classify(model: Model, text: str | None) -> tuple[str, float, str | None]:
    """Language, relative lead over the second one, and the second one."""
    if not has_letter(text) or not model.dictionaries:
        return UNKNOWN, 0.0, None
    data = plain(text)
    pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
    sizes = sorted(
        (sum(len(c.compress(p)) for p in pieces), lang) for lang, c in _compressors(model)
    )
    if len(sizes) == 1:
        return sizes[0][1], 1.0, None
    (best, lang), (second, other) = sizes[:2]
    return lang, (second - best) / second, other


_RESULT = "lang_pred string, score double, second string"


def teller(spark: SparkSession, model: Model):
    """A function of a text column: struct of ``lang_pred, score, second``."""
    ship(spark)

    @F.pandas_udf(_RESULT)
    def tell(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(
                [classify(model, t) for t in texts], columns=["lang_pred", "score", "second"]
            )

    return tell


def is_accepted(told: Column, min_margin: float = MIN_MARGIN) -> Column:
    return (told["lang_pred"] != UNKNOWN) & (told["score"] >= min_margin)


def identify(spark: SparkSession, docs: DataFrame, model: Model, text: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` plus ``lang_pred``, ``score`` (0 to 1), ``second`` and ``accepted``.

    The score is the lead of the best language over the second one relative to
    the second one's bytes.  Texts that are null, empty or without a letter are
    ``und`` with score 0; equal sizes go to the first language by code point,
    with score 0.  ``accepted`` is false for ``und`` and for leads under
    ``min_margin``.  Equal texts get equal results, repeated rows stay, an empty
    table stays empty, and texts are read whole, in pieces.  Columns of ``docs``
    with one of the new names are replaced.
    """
    at = free_name(docs, "_told")
    told = docs.withColumn(at, teller(spark, model)(F.col(text)))
    return told.withColumns({
        "lang_pred": F.col(at)["lang_pred"],
        "score": F.col(at)["score"],
        "second": F.col(at)["second"],
        "accepted": is_accepted(F.col(at), min_margin),
    }).drop(at)


def accept(spark: SparkSession, docs: DataFrame, model: Model, text: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of ``docs`` whose language is told with enough of a lead,
    unchanged, whatever their columns are called."""
    at = free_name(docs, "_told")
    told = docs.withColumn(at, teller(spark, model)(F.col(text)))
    return told.where(is_accepted(F.col(at), min_margin)).drop(at)
