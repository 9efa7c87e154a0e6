"""Token ids of whole texts: each distinct word of a task meets the tokenizer once."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from filetide.llm.words import ranges, split_words

PLAIN = "^[a-zÀ-ÖØ-öø-ÿ]+$"  # words that are one piece to the tokenizer
MARKED = "^([a-zÀ-ÖØ-öø-ÿ]+)[.,;:!?|]$"  # such a word and one mark, which is a piece of its own
SAMPLES = ("Straße, ÉTÉ and don't: 3.14\t(x_y)\n日本語 😀 A-B", "MiXed  CASE,words!", "a\x0bb\x0cc\rd", "…“q”?!")
CACHED_WORDS = 400_000
CACHED_IDS = 4_000_000


class WordTokens:
    """Encodes word by word, which is exact for a tokenizer that lowers case, drops white space and
    never merges across it; others are refused. ``word_end`` ends the last token of every piece in the
    vocabulary. Added tokens are found in a text as it is written, before case is lowered: a word that holds
    one, in whatever case, keeps its case."""

    def __init__(self, path: str, word_end: str = "</w>"):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.quick = Tokenizer.from_file(path)  # for plain words in lower case, which need no normaliser
        self.quick.normalizer = None
        self.quick.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith(word_end)
        self.added = sorted({str(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()})
        self._forget()
        for text in (*SAMPLES, *(f"Ab{t}. {t.upper()}x {t.swapcase()}" for t in self.added)):
            whole = self.tokenizer.encode(text, add_special_tokens=False).ids
            if self.encode(pa.array([text]))[0].tolist() != whole:
                raise ValueError(f"{path} does not encode word by word: {text!r}")

    def _forget(self):
        self.place: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 20, np.int32), 0
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _add(self, words: list[str], ids: np.ndarray, counts: np.ndarray):
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(len(ids) + self.used, np.int32)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.place.update(zip(words, range(len(self.starts), len(self.starts) + len(words))))
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.used += len(ids)

    def _learn(self, words: list[str]):
        plain = pc.match_substring_regex(pa.array(words, pa.string()), PLAIN).to_numpy(zero_copy_only=False)
        simple = [w for w, p in zip(words, plain) if p]
        if simple:
            ids = np.concatenate([np.array(self.quick.encode_batch_fast(
                [" ".join(simple[i:i + 200]).lower()], add_special_tokens=False)[0].ids, np.int32)
                for i in range(0, len(simple), 200)])
            self._add(simple, ids, np.diff(np.flatnonzero(self.ends[ids]) + 1, prepend=0))
        other = [w for w, p in zip(words, plain) if not p]
        for i in range(0, len(other), 200):
            part = other[i:i + 200]
            coded = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            owner = np.array(coded.word_ids, np.int64)
            self._add(part, np.array(coded.ids, np.int32), np.bincount(owner, minlength=len(part)))

    def _places(self, words: list[str]) -> np.ndarray:
        new = [w for w in words if w not in self.place]
        if self.place and (len(self.place) + len(new) > CACHED_WORDS or self.used > CACHED_IDS):
            self._forget()
            new = words
        if new:
            self._learn(new)
        return np.fromiter((self.place[w] for w in words), np.int64, len(words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the bounds of each text's ids."""
        words, bounds = split_words(texts)
        lower = pc.ascii_lower(words)
        coded = lower.dictionary_encode()
        if self.added:
            special = pc.match_substring_regex(coded.dictionary, "|".join(re.escape(t.lower()) for t in self.added))
            if pc.any(special).as_py():
                coded = pc.if_else(special.take(coded.indices), words, lower).dictionary_encode()
        distinct = coded.dictionary
        if not len(distinct):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        marked = pc.match_substring_regex(distinct, MARKED)
        marks = pc.if_else(marked, pc.utf8_slice_codeunits(distinct, -1), "")
        bare = pc.if_else(marked, pc.utf8_slice_codeunits(distinct, 0, -1), distinct).dictionary_encode()
        mark_codes = marks.dictionary_encode()
        known = pa.concat_arrays([bare.dictionary, mark_codes.dictionary]).unique()
        places = self._places([w for w in known.to_pylist() if w])
        index = np.full(len(known), -1)
        index[pc.not_equal(known, "").to_numpy(zero_copy_only=False)] = places
        codes = coded.indices.to_numpy(zero_copy_only=False)
        of = lambda parts: index[pc.index_in(parts.dictionary, known).to_numpy(zero_copy_only=False)][
            parts.indices.to_numpy(zero_copy_only=False)]
        two = np.column_stack([of(bare), of(mark_codes)])
        counts = np.where(two < 0, 0, self.counts[two])
        own = self.flat[ranges(np.where(two < 0, 0, self.starts[two]).ravel(), counts.ravel())]
        counts = counts.sum(axis=1)
        per_word = counts[codes]
        ids = own[ranges((np.cumsum(counts) - counts)[codes], per_word)]
        return ids, np.concatenate([[0], np.cumsum(per_word)])[bounds]
