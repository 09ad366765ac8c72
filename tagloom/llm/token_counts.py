"""Token counts of a word-level BPE with word ends, by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from itertools import accumulate

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import forget, map_texts, text_runs

# Pre-tokens whose counts a task remembers at most, about 60 MB; beyond it the older half goes.
REMEMBERED = 400_000
# Bytes of pre-tokens that are merged together at most, or one longer pre-token.
MERGED_BYTES = 1 << 20
# Characters of a text that are looked at together.
RUN_CHARS = 1 << 18
NO_RANK = np.iinfo(np.int32).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    shifted = [n for n in range(256) if n not in printable]
    letters = {n: chr(n) for n in printable} | {n: chr(256 + at) for at, n in enumerate(shifted)}
    return [letters[n] for n in range(256)]


def _ranges(points: list[int]) -> str:
    """Code points as the inside of a character class."""
    parts, numbers = [], np.array(points, np.int64)
    for run in np.split(numbers, np.flatnonzero(np.diff(numbers) != 1) + 1):
        parts.append(f"\\U{run[0]:08x}-\\U{run[-1]:08x}")
    return "".join(parts)


def newer_characters(pattern: str) -> tuple[dict[str, str], dict[int, str]]:
    """Where Python's character tables and the vocabulary's own library differ, for code points Python does not know yet.

    Gives the classes (``L``, ``N``) of which the library leaves out code points that ``regex`` counts in, as insides of
    a character class, and the lower case of letters that only the library can lower. Without the library both are empty.
    """
    try:
        from tokenizers import Regex, normalizers, pre_tokenizers
    except ImportError:
        return {}, {}
    unknown = [n for n in range(0x110000) if not 0xD800 <= n < 0xE000 and unicodedata.category(chr(n)) == "Cn"]
    text = "".join(map(chr, unknown))
    lowered = normalizers.Lowercase().normalize_str(text)
    lower = {n: c for n, c in zip(unknown, lowered) if chr(n) != c} if len(lowered) == len(text) else {}
    split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
    beyond = {}
    for name in ("L", "N"):
        listed = [ord(c) for c in regex.findall(rf"\p{{{name}}}", text)]
        # A letter joins the letter before it, a number and a sign do not; a sign joins the sign before it.
        before = "a" if name == "L" else "!"
        pieces = split.pre_tokenize_str(" ".join(before + chr(n) for n in listed)) if listed else []
        whole = {piece[1] for piece, _ in pieces if len(piece) == 2}
        left_out = [n for n in listed if (chr(n) in whole) != (name == "L")]
        if left_out:
            beyond[name] = _ranges(left_out)
    return beyond, lower


class WordMerges:
    """Vocabulary as arrays: the symbol of each byte inside and at the end of a word, and merges sorted by pair."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        end = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = np.array([vocab[letter] for letter in letters], np.int64)
        self.final = np.array([vocab[letter + end] for letter in letters], np.int64)
        self.base = max(vocab.values()) + 1
        merges = [tuple(pair) if isinstance(pair, list) else tuple(pair.split(" ")) for pair in model["merges"]]
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        pre = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = pre
        self.beyond, self.lower = newer_characters(pre)
        self.specials = [token["content"] for token in spec["added_tokens"]]

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.ranks[at], NO_RANK)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """How many symbols of each non-empty word survive.

        All words lie end to end in one array. Each round finds the lowest rank
        of every word and applies that pair wherever it occurs in the word, left
        to right; of overlapping places in a run of equal symbols every second
        one is taken. A symbol is made by one merge only, and later merges rank
        higher, so taking all places at once gives what one at a time would.
        Finished words leave the arrays.
        """
        lengths = np.array([len(word) for word in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[raw]
        last = np.cumsum(lengths) - 1
        symbols[last] = self.final[raw[last]]
        word_of = np.repeat(np.arange(len(words)), lengths)
        result = np.zeros(len(words), np.int64)
        names = np.arange(len(words))
        # The rank of each symbol with the next one; none at the end of a word.
        ranks = np.full(len(symbols), NO_RANK, np.int32)
        inside = np.flatnonzero(word_of[:-1] == word_of[1:])
        ranks[inside] = self.ranks_of(symbols[inside], symbols[inside + 1])
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word_of[1:] != word_of[:-1]])
            lowest = np.minimum.reduceat(ranks, starts)
            sizes = np.diff(np.r_[starts, len(symbols)])
            done = lowest == NO_RANK
            result[names[done]] = sizes[done]
            here = np.flatnonzero((ranks == np.repeat(lowest, sizes)) & (ranks != NO_RANK))
            firsts = np.flatnonzero(np.r_[True, np.diff(here) != 1][: len(here)])
            in_run = np.arange(len(here)) - np.repeat(firsts, np.diff(np.r_[firsts, len(here)]))
            here = here[in_run % 2 == 0]
            symbols[here] = self.made[ranks[here]]
            ranks[here] = ranks[here + 1]  # the end of a word stays one
            stays = np.repeat(~done, sizes)
            stays[here + 1] = False
            changed = (np.cumsum(stays) - 1)[here]
            symbols, ranks = symbols[stays], ranks[stays]
            left = np.cumsum(~done) - 1
            word_of, names = left[word_of[stays]], names[~done]
            # Only pairs beside a merged symbol have a new rank.
            beside = np.unique(np.r_[changed - 1, changed])
            beside = beside[(beside >= 0) & (beside < len(symbols) - 1)]
            beside = beside[word_of[beside] == word_of[beside + 1]]
            ranks[beside] = self.ranks_of(symbols[beside], symbols[beside + 1])
        return result


class Counter:
    """Counts the tokens of texts, remembering pre-tokens."""

    def __init__(self, merges: WordMerges):
        self.merges = merges
        self.split = regex.compile(merges.pattern).findall
        self.special = regex.compile("|".join(map(regex.escape, merges.specials))) if merges.specials else None
        self.known: dict[str, int] = {}
        # Characters that the library's tables take otherwise are rare: texts with one go by a pattern that says so.
        pattern = merges.pattern
        for name, left_out in merges.beyond.items():
            pattern = pattern.replace(rf"\p{{{name}}}", rf"[\p{{{name}}}--[{left_out}]]")
        self.split_newer = regex.compile(pattern, regex.V1).findall
        newer = "".join(merges.beyond.values()) + (_ranges(sorted(merges.lower)) if merges.lower else "")
        self.newer = regex.compile(f"[{newer}]").search if newer else None

    def words(self, text: str) -> list[str]:
        newer = self.newer is not None and not text.isascii() and self.newer(text)
        # Lower case letter by letter: a final sigma is no special case.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return self.split_newer(text.translate(self.merges.lower)) if newer else self.split(text)

    def learn(self, new: list[str]) -> None:
        raw = [word.encode() for word in new]
        bounds = np.fromiter(accumulate(map(len, raw)), np.int64, len(raw)) // MERGED_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(bounds)) + 1).tolist(), len(raw)]
        for first, after in zip(cuts, cuts[1:]):
            self.known.update(zip(new[first:after], self.merges.counts(raw[first:after]).tolist()))

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text; what is new in several short texts is merged together."""
        totals = [0] * len(texts)
        waiting: list[tuple[int, list[str]]] = []
        held = 0
        for at, text in enumerate(texts):
            for run in text_runs(text, RUN_CHARS):
                parts = [run]
                if self.special and "<" in run:
                    parts = self.special.split(run)
                    totals[at] += len(parts) - 1
                waiting.append((at, [word for part in parts for word in self.words(part)]))
                held += len(run)
                if held >= RUN_CHARS:
                    self.settle(waiting, totals)
                    waiting, held = [], 0
        self.settle(waiting, totals)
        return totals

    def settle(self, waiting: list[tuple[int, list[str]]], totals: list[int]) -> None:
        forget(self.known, REMEMBERED)
        new = {word for _, words in waiting for word in words if word not in self.known}
        if new:
            self.learn(list(new))
        for at, words in waiting:
            totals[at] += sum([self.known[word] for word in words])


COUNTED = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])


def token_counts(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens) of each whole text, as the vocabulary's own library counts without special tokens added.

    ``vocabulary`` is a JSON file of a BPE with word ends, read by the driver.
    Strings of its special tokens inside a text count one each. A NULL text is
    empty and has no tokens. NULL and repeated keys are rows like any other;
    other columns are ignored. Nothing is shuffled; a text is walked in bounded
    pieces cut before white space (as Unicode's property has it), which no
    pre-token spans.
    """
    merges = WordMerges(vocabulary)

    def make() -> Callable[[list[str]], list[tuple]]:
        counter = Counter(merges)
        return lambda texts: list(zip([len(value.encode()) for value in texts], counter.count(texts)))

    return map_texts(docs.select(F.col(key), F.col(text).alias("_text")), "_text", make, COUNTED)
