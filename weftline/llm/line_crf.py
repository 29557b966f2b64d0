"""Quality rules of whole texts: counted base rules, then the share of content lines.

A linear-chain conditional random field labels every line of a text content or boilerplate from the
shape of its words; Viterbi decoding picks the labels, and a text is kept if enough of its word
characters stand in content lines.  The field is trained here, on the labelled lines below.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weftline.llm.buffers import Words, blocks, mix, range_hashes, text_bytes, words_between_blanks
from weftline.llm.crf import LinearChain, fit

LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of the words that may lie in repeated windows
LEAST_CONTENT = 0.5  # share of word characters in content lines

# The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

# Labelled texts the field is trained on; lines that begin with "-" are boilerplate.
LABELLED = """
 The river rose twice that spring, and both times the lower fields were under water for a week.
 Nobody in the village could remember a year like it, though some of them tried.
 In May the council met to talk about the old dam.
 It was decided to wait.

 Der Zug kam mit einer Stunde Verspätung an, und der Bahnsteig war schon leer.
 Sie nahm ihren Koffer und ging langsam zum Ausgang, wo niemand auf sie wartete.
 Licensed under CC BY 4.0.

 Le marché ouvre à six heures, mais les pêcheurs arrivent bien avant.
 On y trouve du poisson, des légumes et parfois des fleurs.
 La pluie n'y change rien.

 El camino sube entre los pinos hasta una casa pequeña que nadie habita.
 Desde allí se ve el mar, y en los días claros también las islas.

 How to store bread
 Keep it in a paper bag, not in plastic, and never in the fridge.
 A loaf of 500 g lasts about three days; after that, toast it.
 All rights reserved.

 Results were measured in 2019 and again in 2021 at 14 sites.
 Mean values differ by 3.2 percent, which is within the error of the method.
 Yes.

- Home | News | Sport | Weather | Contact |
- Shop | Cart | Checkout | Help |
 The shop opens at nine on weekdays and at ten on Saturdays, except in August.
- Previous | 1 | 2 | 3 | Next |

- Login | Register | Password | Forgotten |
- Terms | Privacy | Imprint | Sitemap |

- BUY NOW!! BEST PRICE!! ONLY TODAY!! FREE SHIPPING!!
- CLICK HERE!! WIN BIG!! DO NOT MISS!!
- OFFER ENDS SOON!!
 We sell garden tools and seeds, and have done so for thirty years.

- GRATIS!! NUR HEUTE!! JETZT KAUFEN!!
- LIMITED OFFER!! CALL NOW!! CALL NOW!! CALL NOW!!

- win### cash*** now&&& fast%%% easy$$$ money### here*** best%%%
- $$$ $$$ *** free*** %%% deal%%% &&& ### sale###
- click&&& this&&& link&&& today***

 We are open again after the holidays, and glad to see you.
- best&&& shop&&& in%%% town*** and$$$ the### nicest*** people%%% you%%% will&&& meet***

- der*** beste### preis%%% hier&&& und$$$ jetzt***
 Alle Preise verstehen sich einschließlich der Mehrwertsteuer und des Versands.

- cheap cheap cheap cheap cheap cheap cheap cheap cheap cheap
- shoes shoes shoes shoes shoes shoes shoes shoes
- la la la la la la la la la la la la
- buy buy buy shop shop shop deal deal deal

- casa casa casa casa casa casa casa casa casa
- mar, mar, mar, mar, mar, mar, mar, mar,
 Una casa junto al mar, con dos ventanas y una puerta azul.

- tag tag cloud cloud seo seo rank rank link link page page
- foo foo bar bar baz baz qux qux
- next next next next

- <<< back >>> <<< top >>> <<< home >>>
- ||| menu ||| search ||| close |||
 Search results are shown in the order in which the pages were added.
- >>> >>> >>>
"""

FEATURES = 10


def _classes() -> np.ndarray:
    """For each byte, the columns counted: character, symbol, upper case, mark, digit, letter."""
    table = np.zeros((256, 6), bool)
    table[:, 0] = (np.arange(256) & 0xC0) != 0x80
    table[list(SYMBOLS), 1] = True
    table[65:91, 2] = True
    table[ord("!"), 3] = True
    table[48:58, 4] = True
    table[65:91, 5] = table[97:123, 5] = table[0xC0:, 5] = True
    return table


def _sums(mask: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total


def _first_equal(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key, whether an equal one stands earlier, and whether another one is equal."""
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    later, shared = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = same
    shared[order] = np.r_[False, same] | np.r_[same, False] if len(key) else same
    return later, shared


class Measured:
    """Counts of every text and features of every line of a block."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        texts = len(offsets) - 1
        is_blank = ~words_between_blanks()
        fold = np.arange(256, dtype=np.uint8)
        words = Words(data, offsets, words_between_blanks(), fold)
        key, text = words.key, words.text
        table = _classes()
        chars = _sums(table[data, 0] & ~is_blank[data])
        self.n_words = words.count
        self.word_chars = chars[offsets[1:]] - chars[offsets[:-1]]
        symbols = _sums(table[data, 1])
        self.n_symbols = symbols[offsets[1:]] - symbols[offsets[:-1]]

        # words in windows of three that the text has twice
        salt = mix(np.arange(texts, dtype=np.uint64) + np.uint64(7))
        repeated = np.zeros(len(key), bool)
        if len(key) > 2:
            window = key[:-2] * np.uint64(3) + key[1:-1] * np.uint64(0x9E3779B97F4A7C15)
            window = mix(window + key[2:] * np.uint64(0xD1B54A32D192ED03)) + salt[text[:-2]]
            whole = np.flatnonzero(text[:-2] == text[2:])
            twice = whole[_first_equal(window[whole])[1]]
            for i in range(3):
                repeated[twice + i] = True
        self.n_repeat_words = np.bincount(text[repeated], minlength=texts)

        # lines: what \n parts, those with a word
        feeds = np.flatnonzero(data == 10)
        start = np.concatenate([offsets[:-1], feeds + 1])
        start = np.unique(start[start < len(data)])
        end = np.r_[start[1:], len(data)]
        owner = np.searchsorted(offsets, start, "right") - 1
        end = np.minimum(end, offsets[owner + 1])
        end = end - ((end > start) & (data[np.maximum(end, 1) - 1] == 10))
        low, high = np.searchsorted(words.start, start), np.searchsorted(words.start, end)
        kept = high > low
        start, end, owner, low, high = (a[kept] for a in (start, end, owner, low, high))
        line_key = mix(range_hashes(data, start, end) + salt[owner])
        later = _first_equal(line_key)[0]
        self.n_dup_lines = np.bincount(owner[later], minlength=texts)
        self.line_text, self.lines_before = owner, np.searchsorted(owner, np.arange(texts + 1))
        self.line_chars = chars[end] - chars[start]

        n = np.maximum(high - low, 1)
        near = np.zeros(len(key), bool)  # words equal to the one before or the one before that
        for back in (1, 2):
            near[back:] |= (key[back:] == key[:-back]) & (text[back:] == text[:-back])
        letters = _sums(table[data, 5])
        no_letters = letters[words.end] == letters[words.start]
        share = lambda mask: (lambda s: (s[high] - s[low]) / n)(_sums(mask))
        line_letters = np.maximum(letters[end] - letters[start], 1)
        bytes_of = lambda column: (lambda s: s[end] - s[start])(_sums(table[data, column]))
        self.features = np.stack(
            [
                np.ones(len(start)),
                np.minimum(1, bytes_of(1) / n),
                share(no_letters),
                np.minimum(1, bytes_of(2) / line_letters),
                np.minimum(1, bytes_of(3) / n),
                share(near),
                share(repeated),
                later.astype(float),
                np.minimum(1, np.log1p(n) / 5),
                np.minimum(1, bytes_of(4) / n),
            ],
            axis=1,
        )


@lru_cache(maxsize=1)
def trained() -> LinearChain:
    """The field, fitted to LABELLED."""
    sequences, labels = [], []
    for text in LABELLED.strip("\n").split("\n\n"):
        lines = text.split("\n")
        body = "\n".join(line[1:].strip() for line in lines).encode()
        measured = Measured(np.frombuffer(body, np.uint8), np.array([0, len(body)]))
        sequences.append(measured.features)
        labels.append(np.array([line[0] != "-" for line in lines], int))
    return fit(sequences, labels, rounds=600, penalty=1e-4)


def line_labels(texts: list[str], field: LinearChain | None = None) -> list[list[int]]:
    """Labels (1 content, 0 boilerplate) of the lines with words of each text."""
    field = field or trained()
    raw = [t.encode() for t in texts]
    offsets = np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64)
    measured = Measured(np.frombuffer(b"".join(raw), np.uint8), offsets)
    scores, bounds = field.scores(measured.features).tolist(), measured.lines_before.tolist()
    return [field.decode(scores[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_rules(
    df: DataFrame,
    text: str = "text",
    field: LinearChain | None = None,
    least_content: float = LEAST_CONTENT,
) -> DataFrame:
    """``df`` with the counts of COUNTS, ``base_failed``, ``content_share`` and ``kept``.

    Words are what lies between ASCII blanks.  ``n_dup_lines`` counts lines with a word that equal
    an earlier line, ``n_repeat_words`` words in 3-word windows that the text has twice or more.  A
    text fails the base rules with fewer than 50 words or more than half of them repeated; else it
    is kept if content lines hold ``least_content`` of its word characters.  Null and empty texts
    have no words and fail; repeated rows are all returned; columns of ``df`` named like the new
    ones are replaced; an empty table gives an empty result.  Nothing is shuffled.
    """
    added = (*COUNTS, "base_failed", "content_share", "kept")
    df = df.drop(*added)
    names, field = df.columns, field or trained()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text):
            measured = Measured(*text_bytes(block.column(text)))
            scores = field.scores(measured.features).tolist()
            bounds = measured.lines_before.tolist()
            labels = [field.decode(scores[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
            content = np.array([x for l in labels for x in l], bool)
            chars = np.bincount(
                measured.line_text[content], measured.line_chars[content], minlength=len(block)
            )
            share = chars / np.maximum(measured.word_chars, 1)
            failed = (measured.n_words < LEAST_WORDS) | (
                100 * measured.n_repeat_words > MOST_REPEATED * measured.n_words
            )
            columns = [block.column(n) for n in names]
            columns += [pa.array(getattr(measured, c).astype(np.int64)) for c in COUNTS]
            columns += [pa.array(failed), pa.array(share), pa.array(~failed & (share >= least_content))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *added])

    counts = ", ".join(f"{c} long" for c in COUNTS)
    schema = f"{df.schema.simpleString()[7:-1]}, {counts}, base_failed boolean, content_share double, kept boolean"
    return df.mapInArrow(judge, schema)
