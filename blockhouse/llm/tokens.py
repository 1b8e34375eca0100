"""Token ids with a public byte-level BPE vocabulary (path is a parameter).

The pre-tokeniser never lets a token cross from a non-space character into a
following space, so a text is the concatenation of its pieces between such places
(``_CUT``), and equal pieces have equal ids.
"""
from __future__ import annotations

import os
import re
import sys
from array import array


_NO_CUT = re.compile(r"\s ")           # a space after white space: the plain split would be wrong
_CUT = re.compile(r"(?<=\S)(?= )")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The printable character that a byte-level vocabulary writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _packed(ids: list[int]) -> bytes:
    a = array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


class Encoder:
    """text -> little-endian unsigned 32-bit ids (no special tokens).

    Reads the vocabulary file of ``tokenizers``.  Its ids are in merge order, so
    they are the ranks that tiktoken's faster merge loop needs; the two give the
    same ids (a probe is compared here, whole texts in the tests), and a
    vocabulary for which they differ is encoded by ``tokenizers`` itself.
    Special-token strings in a text are ordinary text.
    """

    PROBE = "It's a probe: caf\u00e9 12,345 \n\n  na\u00efve\u2014words!! \u4e2d\u6587 \U0001f600 don't"

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(vocabulary)
        tok.encode_special_tokens = True
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in tok.get_vocab(with_added_tokens=False).items() if all(c in letters for c in t)}
        try:
            fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            same = fast.encode_ordinary(self.PROBE) == tok.encode(self.PROBE, add_special_tokens=False).ids
        except KeyError:  # a byte without a token
            same = False
        self._encode = fast.encode_ordinary if same else lambda t: tok.encode(t, add_special_tokens=False).ids
        self.top = max(tok.get_vocab(with_added_tokens=True).values())

    def ids(self, text: str) -> bytes:
        return _packed(self._encode(text))


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]
