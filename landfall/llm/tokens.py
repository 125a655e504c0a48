"""Public tokenizers for use inside tasks: whole texts in, arrays of ids out."""

import json
import re
from array import array
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

CACHE_WORDS = 500_000
LONG_WORD = 48
#: Characters on which this module's pattern of words agrees with the tokenizer's own; they have not
#: changed their Unicode class for long. Texts with others are cut by the tokenizer itself.
_PLAIN = re.compile(
    "[\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-ԧ‐-⁞←-⇿ぁ-ゖァ-ヺ"
    "一-龥가-힣]*+")
_WORDS = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


@lru_cache
def byte_letters():
    """The letter by which byte-level vocabularies write each byte: itself if printable in Latin-1."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class _Words(dict):
    """word -> its ids as bytes, which cost no work of the garbage collector; emptied when full."""

    def __init__(self, model):
        super().__init__()
        self._tokenize, self._letters = model.tokenize, dict(enumerate(byte_letters()))

    def __missing__(self, word):
        letters = word.encode().decode("latin-1").translate(self._letters)
        ids = array("i", [t.id for t in self._tokenize(letters)]).tobytes()
        if len(word) <= LONG_WORD:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = ids
        return ids


class ByteBpe:
    """Byte-level BPE from a ``tokenizers`` file.

    The model merges within words only, so words' ids are remembered and texts put together from
    them; the result equals encoding the whole text. ``specials`` tells whether strings of special
    tokens in a text become their ids, or are plain text.
    """

    def __init__(self, path, specials=False):
        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = not specials
        told = json.loads(self._whole.to_str())
        cut = told["pre_tokenizer"] or {}
        self._by_words = (cut.get("type"), cut.get("use_regex"), cut.get("add_prefix_space"), told["normalizer"],
                          told["model"]["type"], told["model"]["dropout"]) == ("ByteLevel", True, False, None, "BPE", None)
        self._marks = [t["content"] for t in told["added_tokens"] if specials or not t["special"]]
        self._known = _Words(self._whole.model)
        #: Every byte has an entry, so the bytes of a text's tokens are those of the text.
        self.whole = self._by_words and not self._marks and set(byte_letters()) <= self._whole.get_vocab().keys()
        self.size = self._whole.get_vocab_size()

    def packed(self, text):
        """The ids of a text as bytes, four for each in the machine's order."""
        if not self._by_words or any(m in text for m in self._marks):
            return array("i", self._whole.encode(text, add_special_tokens=False).ids).tobytes()
        if _PLAIN.fullmatch(text):
            words = _WORDS.findall(text)
        else:
            words = [text[a:b] for _, (a, b) in self._whole.pre_tokenizer.pre_tokenize_str(text)]
        return b"".join(map(self._known.__getitem__, words))

    def ids(self, text):
        return np.frombuffer(self.packed(text), np.int32)

    def token_bytes(self):
        """The bytes of every id; none for ids without an entry."""
        back = {c: b for b, c in enumerate(byte_letters())}
        out = [b""] * self.size
        for token, i in self._whole.get_vocab(with_added_tokens=True).items():
            known = all(c in back for c in token)
            out[i] = bytes(back[c] for c in token) if known else token.encode()
        return out


@lru_cache(maxsize=4)
def byte_bpe(path, specials=False):
    """One ``ByteBpe`` for all tasks that a Python worker runs, with the words it knows."""
    return ByteBpe(path, specials)


class PieceBpe:
    """BPE with byte fallback from a ``sentencepiece`` file."""

    def __init__(self, path):
        import sentencepiece  # only tasks that use it load it

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self._model.get_piece_size()

    def ids(self, texts):
        return [np.array(i, np.int32) for i in self._model.encode(texts, num_threads=1)] if texts else []

    def token_bytes(self):
        """The bytes of every id: a piece's text with spaces for their mark, or the one byte it names."""
        out = []
        for i in range(self.size):
            piece = self._model.id_to_piece(i)
            out.append(bytes([int(piece[3:5], 16)]) if self._model.is_byte(i)
                       else piece.replace("▁", " ").encode())
        return out
