"""Token ids of whole texts by a public tokenizer file.

A tokenizer that lower-cases and takes every run of ASCII white space as a border gives the same ids
for a text as for its white-space-free chunks one after another. Chunks repeat, so each worker
encodes a chunk once and keeps its ids, up to a number of chunks; new chunks of several texts are encoded together. For any other tokenizer, pass
chunked=False: whole texts are then encoded. Special tokens written out in a text count as such, as
the tokenizers library has it; such texts are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

from plumbrow.llm.common import kept


# One word in any of these files: letters that stay letters, and stay apart, when lower-cased and normalised.
_IS_PLAIN = re.compile("[a-zÀ-ÖØ-öø-ÿ]+").fullmatch
# Marks that no file counts among a word's letters; `'`, `-` and `_` may be.
_STOPS = b"!\"#$%&()*+,./:;<=>?@[\\]^`{|}~"
#: Bytes of texts whose new chunks are encoded together.
GROUP_BYTES = 1 << 18


class Encoder:
    """Encodes texts to id bytes: little-endian, two bytes an id where the vocabulary allows it.

    chunked says that the tokenizer lower-cases and drops white space, so that chunks of a text can
    be encoded apart. keep: chunks remembered at most; further ones are encoded whenever they come.
    """

    def __init__(self, path: str, chunked: bool = True, keep: int = 700_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self.dtype = id_type(self._tokenizer.get_vocab_size(with_added_tokens=True))
        self._chunked = chunked
        self._keep = keep
        self._known: dict[bytes, bytes] = {}
        added = self._tokenizer.get_added_tokens_decoder()
        self._ends_word = None
        suffix = getattr(self._tokenizer.model, "end_of_word_suffix", None)
        if suffix:
            tokens = self._tokenizer.get_vocab(with_added_tokens=True)
            self._ends_word = np.zeros(max(tokens.values()) + 1, bool)
            self._ends_word[[i for token, i in tokens.items() if token.endswith(suffix)]] = True
        self._border, self._border_id = next(
            ((t.content, i) for i, t in added.items() if t.special), (None, None)
        )

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype) for e in found]

    def _encode_chunks(self, chunks: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids of chunks without special tokens. Stops after a last letter are a word of their own."""
        known = self._known
        stopped, parts = {}, set()
        for chunk in chunks:
            word = chunk.rstrip(_STOPS)
            if len(word) < len(chunk) and word[-1:].islower():
                stopped[chunk] = pair = word, chunk[len(word) :]
                parts.update(pair)
            else:
                parts.add(chunk)
        found = self._encode_parts(parts.difference(known))
        for chunk, (word, stop) in stopped.items():
            found[chunk] = (found[word] if word in found else known[word]) + (
                found[stop] if stop in found else known[stop]
            )
        return found

    def _encode_parts(self, chunks: Iterable[bytes]) -> dict[bytes, bytes]:
        """Chunks are put into one text with a special token between them; plain words, whose ids show where a word
        ends, with a space, which takes the library less time."""
        words, texts = [], {}
        for chunk in chunks:
            if chunk.isalpha():
                words.append(chunk)
            else:
                texts[chunk] = chunk.decode("utf-8", "replace")
        words += [c for c, t in texts.items() if _IS_PLAIN(t)]
        found = self._encode_words(words) if self._ends_word is not None else {}
        if len(found) < len(words):
            texts.update((c, c.decode("utf-8", "replace")) for c in words)
        else:
            texts = {c: t for c, t in texts.items() if c not in found}
        if self._border is None or not texts:
            return found | {c: ids.tobytes() for c, ids in zip(texts, self._encode(list(texts.values())))}
        ids = self._encode([self._border.join(texts.values())])[0]
        cuts = np.flatnonzero(ids == self._border_id)
        return found | self._cut(texts, ids, np.concatenate(([0], cuts + 1)), np.append(cuts, len(ids)))

    def _encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words, each of which ends in an id that ends words; none if one does not."""
        if not words:
            return {}
        ids = self._encode([b" ".join(words).decode()])[0]
        ends = np.flatnonzero(self._ends_word[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return {}
        return self._cut(words, ids, np.concatenate(([0], ends[:-1])), ends)

    def _cut(self, chunks, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> dict[bytes, bytes]:
        data, size = ids.tobytes(), self.dtype.itemsize
        places = zip(chunks, (starts * size).tolist(), (ends * size).tolist())
        return {c: data[a:b] for c, a, b in places}

    def ids(self, text: bytes) -> bytes:
        """The ids of one whole text."""
        return self._ids_of_group([text])[0]

    def ids_of(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """The ids of each whole text."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP_BYTES:
                yield from self._ids_of_group(group)
                group, size = [], 0
        yield from self._ids_of_group(group)

    def _ids_of_group(self, texts: list[bytes]) -> list[bytes]:
        known = self._known
        out, open_chunks, new = [], [], set()
        for text in texts:
            if not self._chunked or b"<" in text and self._has_special(text):
                out.append([self._encode([text.decode("utf-8", "replace")])[0].tobytes()])
                continue
            chunks = text.lower().split()
            found = list(map(known.get, chunks))
            out.append(found)
            if None in found:
                places = _places(found, None)
                missing = [chunks[i] for i in places]
                new.update(missing)
                open_chunks.append((found, places, missing))
        encoded = self._encode_chunks(new)
        for found, places, missing in open_chunks:
            for i, chunk in zip(places, missing):
                found[i] = encoded[chunk]
        if len(known) + len(new) <= self._keep:
            known.update(encoded)
        return list(map(b"".join, out))

    def _has_special(self, text: bytes) -> bool:
        found = text.lower()
        return any(
            t.content.encode().lower() in found
            for t in self._tokenizer.get_added_tokens_decoder().values()
        )


def _places(values: list, wanted) -> list[int]:
    out, at = [], -1
    try:
        while True:
            at = values.index(wanted, at + 1)
            out.append(at)
    except ValueError:
        return out


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def encoder(path: str, chunked: bool = True) -> Encoder:
    """This worker's encoder for a tokenizer file; tasks that run one after another share it."""
    return kept(("encoder", path, chunked), lambda: Encoder(path, chunked))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The place of an installed public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)
