"""Pieces of words in the sentencepiece vocabulary, kept by each Python worker.

The vocabulary's merges never join a letter to a blank that follows it, nor anything to a
line break: no piece holds either (``independent_words`` checks it).  A text is therefore
encoded word by word, a word being what stands between two blanks or line breaks, together
with the blanks before it.
"""

from __future__ import annotations

import re
from functools import lru_cache

BLANK = "▁"
#: Words a worker remembers; beyond it words are encoded each time.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 40

_UNIT = re.compile(r"\n| +[^ \n]*|[^ \n]+")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def encode_unit(sp, unit: str) -> list[int]:
    """Ids of a unit as it is encoded inside a text.

    The library puts a blank before a text; the line break keeps it off the unit, and its
    two pieces are cut off.
    """
    return sp.encode("\n" + unit)[2:]


def independent_words(sp) -> bool:
    """Whether no piece has a blank after another character, or a line break."""
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    return all(BLANK not in p.lstrip(BLANK) and "\n" not in p for p in pieces)


def whole_tokens(sp) -> dict[str, int]:
    """The proof of the shortcut: vocabulary strings that encode alone as one token.

    Keys are the strings as units, with a blank for the word mark.
    """
    out = {}
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i):
            continue
        unit = sp.id_to_piece(i).replace(BLANK, " ")
        if encode_unit(sp, unit) == [i]:
            out[unit] = i
    return out


class WordTable(dict):
    """Word after one blank -> value of its ids; words not yet seen are encoded.

    ``value`` turns ids into what is kept, ``join`` adds the values of a text up.
    """

    def __init__(self, path: str, value, join):
        super().__init__()
        self.sp, self.value, self.join = processor(path), value, join
        if not independent_words(self.sp):
            raise ValueError(f"{path}: words can't be encoded one by one")
        self.units: dict[str, object] = {"\n": value(encode_unit(self.sp, "\n"))}
        for unit, i in whole_tokens(self.sp).items():
            if unit[:1] == " " and " " not in unit[1:] and len(unit) > 1:
                self[unit[1:]] = value([i])
            else:
                self.units[unit] = value([i])

    def unit(self, unit: str):
        """A unit with its own blanks; for what a table of words can't hold."""
        got = self.units.get(unit)
        if got is None:
            got = self.value(encode_unit(self.sp, unit))
            if len(self.units) < REMEMBERED and len(unit) <= LONGEST_REMEMBERED:
                self.units[unit] = got
        return got

    def __missing__(self, word: str):
        if "\n" in word:
            first, *lines = word.split("\n")
            parts = [self[first] if first else self.unit(" ")]
            for line in lines:
                parts.append(self.units["\n"])
                if line:
                    parts.append(self.unit(line))
            return self.join(parts)
        got = self.value(encode_unit(self.sp, " " + word))
        if len(self) < REMEMBERED and len(word) <= LONGEST_REMEMBERED:
            self[word] = got
        return got

    def text(self, text: str):
        """The value of a whole text."""
        if not text:
            return self.join([])
        if BLANK in text:
            text = text.replace(BLANK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return self.join([self.unit(u) for u in _UNIT.findall(" " + text)])
        return self.join(map(self.__getitem__, text.split(" ")))


def _ids_value(ids: list[int]) -> bytes:
    import numpy as np

    return np.asarray(ids, "<u2").tobytes()


@lru_cache(maxsize=2)
def count_table(path: str) -> WordTable:
    """Word -> number of tokens."""
    return WordTable(path, len, sum)


@lru_cache(maxsize=2)
def id_table(path: str) -> WordTable:
    """Word -> its ids as little-endian 16-bit numbers."""
    if processor(path).get_piece_size() > 1 << 16:
        raise ValueError(f"{path}: ids need more than 16 bits")
    return WordTable(path, _ids_value, b"".join)
