"""Language identification by compression: the dictionary that shortens a text most names its language.

Every language gets a raw-content zstandard dictionary made of pieces of labelled texts. A text is cut into
blocks, each block is compressed with every dictionary, and the language with the smallest total wins; the
score grows with its margin over the second, and narrow margins are marked as rejected.

A text that is null or has no letter is ``und`` with score 0; so is every text if no language was learned.
Ties go to the language with more labelled texts, then to the smaller name. Rows are independent.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import islice

import xxhash
from pyspark.sql import DataFrame

from sievemark.llm.common import append_columns, flat_rows, hashed_sample

DICTIONARY_BYTES = 96 << 10  # per language
SAMPLE_TEXTS = 150  # labelled texts per language
PIECE = 256  # characters of a dictionary piece
PIECES_PER_TEXT = 48
BLOCK = 2048  # bytes compressed at a time
LEVEL = 12  # its parser weighs matches against plain letters; lower levels take matches that do not pay
MIN_MARGIN = 0.01
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
# Letters are compressed in small form; every ASCII character that is no letter reads as a blank.
_BLANKS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def plain(text: str) -> bytes:
    """The letters of a text in small form, words parted by one blank, a word in a row only once."""
    words = text.lower().encode().translate(_BLANKS).split()
    return b" ".join([w for w, before in zip(words, [b"", *words]) if w != before])


def fit_dictionaries(labelled: DataFrame, text: str = "text", lang: str = "lang", texts: int = SAMPLE_TEXTS, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Dictionary per language from a bounded sample: ``texts`` whole texts, of which pieces spread evenly are used."""
    sample = hashed_sample(labelled, lang, text, texts)

    def make():
        def run(langs, bodies):
            for name, body in zip(langs, bodies):
                starts = range(0, max(len(body), 1), PIECE)
                for start in starts[:: max(1, len(starts) // PIECES_PER_TEXT)]:
                    piece = body[start : start + PIECE]
                    if LETTER.search(piece):
                        yield name, xxhash.xxh3_64_intdigest(piece.encode()) >> 1, piece

        return run

    pieces = defaultdict(dict)
    for name, order, piece in flat_rows(sample, [lang, text], "lang string, h bigint, piece string", make).collect():
        pieces[name][order] = piece
    # The most frequent language comes first, so that ties go to it.
    names = sorted(pieces, key=lambda n: (-len(pieces[n]), n))
    return {n: plain("\n".join(p for _, p in sorted(pieces[n].items())))[-size:] for n in names}


class ZstdLanguages:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard as z

        self.names = list(dictionaries)
        self.sizers = []
        for data in dictionaries.values():
            d = z.ZstdCompressionDict(data, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.sizers.append(z.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False).compress)

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score from 0 to 1, relative margin."""
        return self.predict_all([text])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """:meth:`predict` of many texts, one dictionary after the other, whose tables then stay in the cache."""
        known = [i for i, t in enumerate(texts) if t and self.names and LETTER.search(t)]
        blocks, counts = [], []
        for i in known:
            data = plain(texts[i])
            blocks += [data[k : k + BLOCK] for k in range(0, len(data), BLOCK)]
            counts.append(-(-len(data) // BLOCK))
        totals = []
        for size in self.sizers:
            sizes = iter([len(size(b)) for b in blocks])
            totals.append([sum(islice(sizes, n)) for n in counts])
        out = [(UNKNOWN, 0.0, 0.0)] * len(texts)
        for i, sizes in zip(known, zip(*totals)):
            out[i] = self._decided(sizes)
        return out

    def _decided(self, sizes: tuple[int, ...]) -> tuple[str, float, float]:
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.names[0], 1.0, 1.0
        second = min(s for i, s in enumerate(sizes) if i != best)
        margin = (second - sizes[best]) / second
        return self.names[best], margin / (margin + MIN_MARGIN), margin


def predict_language(df: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """The rows with lang_pred, score, margin and rejected (margin under ``MIN_MARGIN``)."""
    shared = df.sparkSession.sparkContext.broadcast(dictionaries)  # at most MAX_CLASSES * DICTIONARY_BYTES

    def make():
        model = ZstdLanguages(shared.value)

        def run(texts):
            names, scores, margins = zip(*model.predict_all(texts)) if texts else ((), (), ())
            return [list(names), list(scores), list(margins), [m < MIN_MARGIN for m in margins]]

        return run

    return append_columns(df, [text], "lang_pred string, score double, margin double, rejected boolean", make)
