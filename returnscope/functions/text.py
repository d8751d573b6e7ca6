"""Text column helpers: normalisation, stopwords and noun lemma rules; tokenising and counting per Arrow batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .labels import col_

# The noun detachment rules of WordNet's morphological processor
# (suffix, replacement), in WordNet's order.
NOUN_RULES = (
    ("s", ""),
    ("ses", "s"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
)

# Common irregular nouns of WordNet's noun exception list (plural, lemma).
IRREGULAR_NOUNS = (
    ("aircraft", "aircraft"), ("analyses", "analysis"), ("antennae", "antenna"), ("appendices", "appendix"),
    ("axes", "axis"), ("bacteria", "bacterium"), ("bases", "basis"), ("brethren", "brother"), ("bureaux", "bureau"),
    ("cacti", "cactus"), ("calves", "calf"), ("cherubim", "cherub"), ("children", "child"), ("crises", "crisis"),
    ("criteria", "criterion"), ("curricula", "curriculum"), ("diagnoses", "diagnosis"), ("dice", "die"),
    ("dwarves", "dwarf"), ("elves", "elf"), ("emphases", "emphasis"), ("errata", "erratum"), ("feet", "foot"),
    ("formulae", "formula"), ("fungi", "fungus"), ("geese", "goose"), ("genera", "genus"), ("grandchildren", "grandchild"),
    ("halves", "half"), ("hooves", "hoof"), ("hypotheses", "hypothesis"), ("indices", "index"), ("knives", "knife"),
    ("larvae", "larva"), ("leaves", "leaf"), ("lice", "louse"), ("lives", "life"), ("loaves", "loaf"),
    ("matrices", "matrix"), ("memoranda", "memorandum"), ("mice", "mouse"), ("nuclei", "nucleus"), ("oases", "oasis"),
    ("oxen", "ox"), ("parentheses", "parenthesis"), ("phenomena", "phenomenon"), ("radii", "radius"),
    ("scarves", "scarf"), ("selves", "self"), ("shelves", "shelf"), ("stimuli", "stimulus"), ("strata", "stratum"),
    ("syllabi", "syllabus"), ("synopses", "synopsis"), ("teeth", "tooth"), ("theses", "thesis"), ("thieves", "thief"),
    ("vertebrae", "vertebra"), ("vertices", "vertex"), ("wives", "wife"), ("wolves", "wolf"),
)


# Spark ML's default English stopword list
# (StopWordsRemover.loadDefaultStopWords("english")), in its own order.
ENGLISH_STOPWORDS = (
    'i', 'me', 'my', 'myself', 'we', 'our', 'ours', 'ourselves', 'you', 'your', 'yours',
    'yourself', 'yourselves', 'he', 'him', 'his', 'himself', 'she', 'her', 'hers', 'herself', 'it',
    'its', 'itself', 'they', 'them', 'their', 'theirs', 'themselves', 'what', 'which', 'who',
    'whom', 'this', 'that', 'these', 'those', 'am', 'is', 'are', 'was', 'were', 'be', 'been',
    'being', 'have', 'has', 'had', 'having', 'do', 'does', 'did', 'doing', 'a', 'an', 'the', 'and',
    'but', 'if', 'or', 'because', 'as', 'until', 'while', 'of', 'at', 'by', 'for', 'with', 'about',
    'against', 'between', 'into', 'through', 'during', 'before', 'after', 'above', 'below', 'to',
    'from', 'up', 'down', 'in', 'out', 'on', 'off', 'over', 'under', 'again', 'further', 'then',
    'once', 'here', 'there', 'when', 'where', 'why', 'how', 'all', 'any', 'both', 'each', 'few',
    'more', 'most', 'other', 'some', 'such', 'no', 'nor', 'not', 'only', 'own', 'same', 'so',
    'than', 'too', 'very', 's', 't', 'can', 'will', 'just', 'don', 'should', 'now', "i'll",
    "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd", "we'd",
    "they'd", "i'm", "you're", "he's", "she's", "it's", "we're", "they're", "i've", "we've",
    "you've", "they've", "isn't", "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't",
    "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't",
    "couldn't", 'cannot', 'could', "here's", "how's", "let's", 'ought', "that's", "there's",
    "what's", "when's", "where's", "who's", "why's", 'would',
)


@lru_cache(maxsize=1)
def english_stopwords() -> tuple[str, ...]:
    """The English stopwords, with every entry that contains an apostrophe also
    split into its parts (tokens never contain apostrophes once non-letters
    are replaced by spaces)."""
    words: set[str] = set()
    for w in ENGLISH_STOPWORDS:
        words.add(w)
        words.update(p for p in w.split("'") if p)
    return tuple(sorted(words))


def normalise(text) -> Column:
    """Lower-case, then every character other than an ASCII letter becomes a space."""
    return F.regexp_replace(F.lower(col_(text)), "[^a-zA-Z]", " ")


def raw_tokens(text) -> Column:
    """Whitespace tokens of the normalised text (an array; may hold one empty
    string for a text without letters)."""
    return F.split(F.trim(normalise(text)), " +")


def kept(word, stopwords: tuple[str, ...] | None = None) -> Column:
    """True for a non-empty token that is not a stopword (row-level IN over
    literals, which the optimizer turns into a hash-set lookup)."""
    stop = stopwords if stopwords is not None else english_stopwords()
    w = col_(word)
    return (w != F.lit("")) & ~w.isin(*stop)


def tokens(text, stopwords: tuple[str, ...] | None = None) -> Column:
    """Array form: whitespace tokens of the normalised text without stopwords."""
    return F.filter(raw_tokens(text), lambda w: kept(w, stopwords))


def noun_candidates(word) -> Column:
    """Array of (rule, candidate) for every detachment rule whose suffix ends
    the word."""
    w = col_(word)
    items = []
    for i, (suffix, repl) in enumerate(NOUN_RULES):
        cand = F.concat(F.left(w, F.length(w) - F.lit(len(suffix))), F.lit(repl))
        items.append(F.when(w.endswith(suffix), F.struct(F.lit(i).alias("rule"), cand.alias("cand"))))
    return F.filter(F.array(*items), lambda x: x.isNotNull())



# -- the same per Arrow batch

SLICE_BYTES = 4 << 20  # text that is tokenised or counted at once


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to about SLICE_BYTES (one row at least)."""
    at, ends = 0, np.cumsum(sizes)
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, "right")))
        yield at, to
        at = to


def _lengths(column: pa.Array, of=pc.list_value_length) -> np.ndarray:
    return pc.fill_null(of(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _lists(lengths: np.ndarray, values: pa.Array, nulls: pa.Array | None = None) -> pa.Array:
    ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    return pa.ListArray.from_arrays(ends, values, mask=nulls if nulls is not None and len(nulls) else None)


def _joined(parts: list[pa.Array], empty: pa.DataType) -> pa.Array:
    return pa.concat_arrays(parts) if parts else pa.array([], empty)


def kept_words(lowered: pa.Array) -> pa.Array:
    """``tokens`` of lower-cased texts: the runs of letters a-z that are no stopwords, in text order (null: null)."""
    stop = pa.array(english_stopwords(), pa.string())

    def of(texts: pa.Array) -> pa.Array:
        whole = texts.cast(pa.large_binary())
        sizes = _lengths(whole, pc.binary_length)
        data = np.frombuffer(b"".join(pc.fill_null(whole, b"").to_pylist()), np.uint8)
        ends = np.cumsum(sizes)
        letter = (data >= 97) & (data <= 122)
        first = np.zeros(len(data) + 1, bool)  # a text begins here: no run goes on from the text before
        first[ends - sizes] = True
        first[-1] = True
        begins = np.flatnonzero(letter & (first[:-1] | ~np.concatenate([[False], letter[:-1]])))
        after = np.concatenate([~letter[1:], [True]]) if len(data) else np.zeros(0, bool)
        stops = np.flatnonzero(letter & (first[1:] | after)) + 1
        offsets = np.concatenate([[0], np.cumsum(stops - begins)]).astype(np.int32)
        words = pa.StringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(data[letter].tobytes()))
        keep = pc.invert(pc.is_in(words, value_set=stop))
        row = np.searchsorted(ends, begins[keep.to_numpy(zero_copy_only=False)], "right")
        return _lists(np.bincount(row, minlength=len(texts)), words.filter(keep), texts.is_null())

    parts = [of(lowered.slice(a, b - a)) for a, b in _slices(_lengths(lowered, pc.binary_length))]
    return _joined(parts, pa.list_(pa.string()))


def word_changes(words: pa.Array | pa.ChunkedArray, lemmas: pa.Array | pa.ChunkedArray) -> Callable[[pa.Array], pa.Array]:
    """A function on lists of words that puts the lemma in place of each of ``words``."""
    words, lemmas = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (words, lemmas))

    def changed(lists: pa.Array) -> pa.Array:
        coded = lists.flatten().dictionary_encode()
        found = pc.index_in(coded.dictionary, value_set=words) if len(words) else pa.nulls(len(coded.dictionary), pa.int32())
        new = pc.coalesce(lemmas.take(found), coded.dictionary)
        return _lists(_lengths(lists), new.take(coded.indices), lists.is_null())

    return changed


def term_counts(lists: pa.Array) -> pa.Array:
    """Per list of terms its distinct terms of two or more letters and their counts (null: empty lists)."""
    parts = []
    sizes = _lengths(lists)
    for a, b in _slices(sizes * 8):
        coded = lists.slice(a, b - a).flatten().dictionary_encode()
        n = max(1, len(coded.dictionary))
        long = pc.greater_equal(pc.utf8_length(coded.dictionary), 2).to_numpy(zero_copy_only=False)
        codes = coded.indices.to_numpy().astype(np.int64)
        keep = long[codes]
        cells = np.sort((np.repeat(np.arange(b - a), sizes[a:b]) * n + codes)[keep])
        begins = np.flatnonzero(np.diff(cells, prepend=-1))
        row, code = np.divmod(cells[begins], n)
        lengths = np.bincount(row, minlength=b - a)
        terms = _lists(lengths, coded.dictionary.take(pa.array(code)))
        counts = _lists(lengths, pa.array(np.diff(begins, append=len(cells)).astype(np.int32)))
        parts.append(pa.StructArray.from_arrays([terms, counts], ["terms", "tfs"]))
    return _joined(parts, pa.struct([("terms", pa.list_(pa.string())), ("tfs", pa.list_(pa.int32()))]))


def joined_words(lowered: pa.Array) -> pa.Array:
    """``kept_words`` of lower-cased texts, joined by a space (null: null)."""
    return pc.binary_join(kept_words(lowered), " ")


def split_words(joined: pa.Array) -> pa.Array:
    """The words of ``joined_words``; without words one empty string (null: null)."""
    return pc.split_pattern(joined, " ")


class CodedCounts(NamedTuple):
    """How often terms occur in rows: per row and term, in order of rows, the term's place in ``terms`` and the count."""

    terms: pa.Array
    code: np.ndarray
    row: np.ndarray
    count: np.ndarray
    rows: int


def coded_counts(terms: pa.Array, counts: pa.Array) -> Iterator[CodedCounts]:
    """Rows of ``term_counts`` with coded terms."""
    coded = terms.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(terms)), _lengths(terms))
    yield CodedCounts(coded.dictionary, coded.indices.to_numpy(), row, counts.flatten().to_numpy(), len(terms))


def joined_counts(words: pa.Array | pa.ChunkedArray, lemmas: pa.Array | pa.ChunkedArray) -> Callable[[pa.Array], Iterator[CodedCounts]]:
    """A function from ``joined_words`` to the ``term_counts`` after the lemma lookup (``word_changes``); each word is coded once,
    and its lemma is looked up in the distinct words of some rows."""
    words, lemmas = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (words, lemmas))

    def counts(joined: pa.Array) -> Iterator[CodedCounts]:
        for a, b in _slices(_lengths(joined, pc.binary_length)):
            lists = split_words(joined.slice(a, b - a))
            coded = lists.flatten().dictionary_encode()
            found = pc.index_in(coded.dictionary, value_set=words) if len(words) else pa.nulls(len(coded.dictionary), pa.int32())
            terms = pc.coalesce(lemmas.take(found), coded.dictionary).dictionary_encode()
            n = max(1, len(terms.dictionary))
            code = terms.indices.to_numpy()[coded.indices.to_numpy()].astype(np.int64)
            long = pc.greater_equal(pc.utf8_length(terms.dictionary), 2).to_numpy(zero_copy_only=False)
            cells = np.sort((np.repeat(np.arange(b - a), _lengths(lists)) * n + code)[long[code]])
            begins = np.flatnonzero(np.diff(cells, prepend=-1))
            row, code = np.divmod(cells[begins], n)
            yield CodedCounts(terms.dictionary, code, row, np.diff(begins, append=len(cells)), b - a)

    return counts
