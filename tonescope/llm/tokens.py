"""Token ids of whole texts, by the model of a given tokenizer file, with repeated words encoded once.

``Encoder`` returns the ids of ``Tokenizer.encode(text, add_special_tokens=False)`` of a byte-level
BPE file. The model only ever looks at one pre-token (a word with its leading space) at a time, so a
text may be cut before a space that follows a visible character. Arrow cuts the texts and tells equal
pieces; only distinct pieces become Python objects, and each goes through the library once per encoder.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress, count, islice

import numpy as np

#: Distinct pieces that an encoder remembers before it starts afresh (some 200 MB).
REMEMBERED = 600_000
#: Pre-tokens of one call of the library.
BLOCK = 16_384
#: The library's pre-token pattern is repeated here for text below this character, whose classes
#: are the same in all versions of Unicode. Other pieces go to the library whole.
SETTLED = "ɐ"
#: White space before a space, and some that the pattern does not count as such: these texts are cut
#: with care.
SPACED = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}] "


def default_tokenizer() -> str:
    """The byte-level BPE file of the installed public vocabularies."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Texts to ids. ``tokenizer`` is the path of a byte-level BPE file without prefix space.

    A special token's string in a text is that token, as the file has it; with ``ordinary`` it is
    ordinary text.
    """

    def __init__(self, tokenizer: str, ordinary: bool = False):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_file(tokenizer)
        self.special = [] if ordinary else [
            t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.whole.encode_special_tokens = ordinary
        self.model = Tokenizer(self.whole.model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        # Every pre-token goes there once: the model's own memory of words would only cost time.
        self.model.model._resize_cache(0)
        # Fixed value: the pattern of the byte-level pre-tokenizer.
        self.pretokens = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall
        self.cut = regex.compile(r"(?<=\S) ").split
        # The visible stand-ins of bytes. Printable ones stand for themselves, the others follow
        # from 256 on.
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = [b for b in range(256) if b not in printable]
        self.alphabet = {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}
        # No text has the bytes 254 and 255: they become the space between two words, and a word whose id
        # tells where each word ends.
        self.alphabet[254] = " "
        self.stop = self.model.token_to_id(chr(self.alphabet[255]))
        self._forget()

    def _forget(self) -> None:
        self.index = defaultdict(count().__next__)
        self.sizes: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []
        self.known = 0
        self.pre: defaultdict[str, int] = defaultdict(count().__next__)
        self.pre_sizes, self.pre_ids = [np.empty(0, np.int64)], [np.empty(0, np.uint32)]

    @staticmethod
    def _settled(piece: str) -> bool:
        return piece.isascii() or max(piece) < SETTLED

    def _learn(self) -> None:
        """Encode the pieces that are new since the last call, by their new pre-tokens."""
        pre, wanted, per_piece, settled = self.pre, [], [], self._settled
        for piece in islice(self.index, self.known, None):
            # A word of letters is one pre-token; so is what goes to the library whole.
            if piece[1:].isalpha() and piece[0] == " " or not (piece and settled(piece)):
                wanted.append(pre[piece])
                per_piece.append(1)
            elif piece[-1] in ".,;:!?" and piece[1:-1].isalpha() and piece[0] == " ":
                wanted += (pre[piece[:-1]], pre[piece[-1]])
                per_piece.append(2)
            else:
                found = self.pretokens(piece)
                wanted += [pre[p] for p in found]
                per_piece.append(len(found))
        self._learn_pretokens()
        flat, lengths = _gathered(self.pre_ids[0], self.pre_sizes[0], np.array(wanted, np.int64))
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        ends = bounds[np.cumsum(np.array(per_piece, np.int64))]
        self.sizes.append(np.diff(ends, prepend=0))
        self.ids.append(flat)
        self.known = len(self.index)

    def _learn_pretokens(self) -> None:
        new = list(islice(self.pre, sum(map(len, self.pre_sizes)), None))
        other = np.array([not p or not p.isascii() and max(p) >= SETTLED for p in new], bool)
        other |= self.stop is None
        mapped = [p.encode() for p in compress(new, ~other)] if other.any() else [
            p.encode() for p in new]
        sizes, ids = [], []
        for at in range(0, len(mapped), BLOCK):
            block = b"\xfe\xff\xfe".join([*mapped[at:at + BLOCK], b""])
            got = np.array(self.model.encode_batch_fast(
                [block.decode("latin1").translate(self.alphabet)], add_special_tokens=False)[0].ids, np.uint32)
            stops = got == self.stop
            sizes.append(np.diff(np.flatnonzero(stops), prepend=-1) - 1)
            ids.append(got[~stops])
        if other.any():  # back to the order of ``new``
            flat = np.concatenate([*ids, np.empty(0, np.uint32)])
            bounds = np.cumsum(np.concatenate([[0], *sizes]).astype(np.int64))
            at, ids = 0, []
            for piece, o in zip(new, other.tolist(), strict=True):
                if o:
                    got = self.whole.encode(piece, add_special_tokens=False) if piece else None
                    ids.append(np.array(got.ids if got else [], np.uint32))
                else:
                    ids.append(flat[bounds[at]:bounds[at + 1]])
                    at += 1
            sizes = [np.array([len(i) for i in ids])]
        self.pre_sizes = [np.concatenate([*self.pre_sizes, *sizes]).astype(np.int64)]
        self.pre_ids = [np.concatenate([*self.pre_ids, *ids])]

    def encode(self, texts, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, each text (None: empty) followed by ``end``, and the texts' bounds.

        ``texts`` is a list or an Arrow array of strings.
        """
        import pyarrow as pa
        import pyarrow.compute as pc
        if self.known > REMEMBERED:
            self._forget()
        index = self.index
        if isinstance(texts, list):
            texts = pa.array(texts, pa.string())
        texts = pc.fill_null(texts, "")
        special = np.zeros(len(texts), bool)
        for token in self.special:
            special |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        spaced = pc.match_substring_regex(texts, SPACED).to_numpy(zero_copy_only=False) & ~special
        simple = ~special & ~spaced

        words = pc.split_pattern(texts.filter(pa.array(simple)), " ")
        counts = np.ones(len(texts), np.int64)
        counts[simple] = pc.list_value_length(words).to_numpy()
        odd = {}
        for i in np.flatnonzero(spaced).tolist():
            first, *others = self.cut(texts[i].as_py())
            odd[i] = [index[first], *[index[" " + w] for w in others]]
            counts[i] = len(odd[i])
        coded = words.flatten().dictionary_encode()
        pieces = pc.binary_join_element_wise(pa.scalar(" "), coded.dictionary, pa.scalar(""))
        known = np.fromiter(map(index.__getitem__, _strings(pieces)), np.int64, len(pieces))

        # Each text's pieces, then its end.
        ends = np.cumsum(counts + 1)
        starts = ends - counts - 1
        wanted = np.full(int(ends[-1]) if len(ends) else 0, -1, np.int64)
        inside = np.repeat(simple, counts + 1)
        inside[ends - 1] = False
        wanted[inside] = known[coded.indices.to_numpy()]
        firsts = words.flatten().take(pa.array(np.cumsum(counts[simple]) - counts[simple]))
        wanted[starts[simple]] = [index[w] for w in _strings(firsts)]
        for i, row in odd.items():
            wanted[starts[i]:ends[i] - 1] = row
        # The library itself cuts what holds special tokens; its ids are kept behind the others.
        whole = [np.array(self.whole.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
                 for i in np.flatnonzero(special).tolist()]
        self._learn()
        if len(self.sizes) > 1:
            self.sizes, self.ids = [np.concatenate(self.sizes)], [np.concatenate(self.ids)]
        wanted[starts[special]] = len(self.sizes[0]) + np.arange(len(whole))
        flat, lengths = _gathered(
            np.concatenate([self.ids[0], *whole, np.array([end], np.uint32)]),
            np.concatenate([self.sizes[0], np.array([*map(len, whole), 1], np.int64)]), wanted)
        bounds = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], ends])]
        return flat, bounds


@lru_cache(maxsize=1)
def kept_encoder(tokenizer: str) -> Encoder:
    """The encoder of a Python worker, with the pieces that its earlier tasks have met."""
    return Encoder(tokenizer)


def _gathered(flat: np.ndarray, sizes: np.ndarray, wanted: np.ndarray):
    """The wanted stretches of ``flat`` one after another, and their sizes."""
    starts = np.cumsum(sizes) - sizes
    wanted = np.where(wanted < 0, wanted + len(sizes), wanted)
    lengths = sizes[wanted]
    at = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts[wanted] - at, lengths) + np.arange(lengths.sum())], lengths


def _strings(texts) -> list[str]:
    """An Arrow array of strings as a list; ``to_pylist`` takes ten times as long."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def slices(texts, most: int = 8_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows of an Arrow array of about ``most`` bytes of text, at least one row each."""
    import pyarrow.compute as pc
    start, size = 0, 0
    for i, length in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_numpy().tolist()):
        size += length
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
