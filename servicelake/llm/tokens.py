"""Token ids by the ``tokenizers`` library, with a memory of whole space-delimited pieces.

A byte-level BPE of this kind never lets a token span the boundary before a
single space that stands between two other characters.  So the texts of a batch
are split at spaces, each distinct piece of the batch is encoded once (or
remembered from before), and the ids are put together by position.  A text with
a space next to other white space, or at its end, goes to the library whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
_WHITE = r"[\t-\r\x1c-\x1f \x{85}\p{Z}]"
_BESIDE_SPACE = f" {_WHITE}|{_WHITE} | $"
_MARKS = ".,"
_LOADED: dict[str, "Encoder"] = {}


def tokenizer_path(name: str) -> str:
    """A file of its own if ``name`` is a path, else the public vocabulary of that name."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    def __init__(self, name: str, most: int = 500_000):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(tokenizer_path(name))
        self.special = [str(t.content) for t in self.lib.get_added_tokens_decoder().values()]
        vocab = self.lib.get_vocab(with_added_tokens=True)
        self.n_bytes = np.zeros(max(vocab.values()) + 1, np.int64)  # one character of a vocabulary entry stands for one byte
        for token, k in vocab.items():
            self.n_bytes[k] = len(token)
        self.known: dict[str, bytes] = {}  # by the piece without its leading space
        self.most = most
        self.full = 0
        self.mark = {m: self._whole([m])[0] for m in _MARKS}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.lib.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.asarray(x.ids, dtype="<u4").tobytes() for x in found]

    def _joined(self, words: list[str]) -> list[bytes]:
        """Ids of words, each behind a space: end to end in texts of some thousand, cut apart by their bytes."""
        out: list[bytes] = []
        for at in range(0, len(words), 2000):
            text = " " + " ".join(words[at : at + 2000])
            data = np.frombuffer(text.encode(), np.uint8)
            ends = np.append(np.flatnonzero(data == 32)[1:], len(data))  # a word holds no space
            ids = np.asarray(self.lib.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = (4 * np.searchsorted(np.cumsum(self.n_bytes[ids]), ends) + 4).tolist()
            blob = ids.tobytes()
            out += [blob[x:y] for x, y in zip([0, *cuts[:-1]], cuts, strict=True)]
        return out

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of new pieces; a mark after a letter is a token run of its own, so the word before it is shared."""
        known = self.known
        marked = [p for p in pieces if p[-1] in _MARKS and p[-2:-1].isalpha()]
        others = [p for p in pieces if p[-1] not in _MARKS or not p[-2:-1].isalpha()] if marked else pieces
        bases = {p[:-1] for p in marked} - known.keys()
        words = [p for p in others if p not in bases] + list(bases)
        new = dict(zip(words, self._joined(words), strict=True))
        new.update([(p, (new.get(p[:-1]) or known[p[:-1]]) + self.mark[p[-1]]) for p in marked])
        return new

    def _remember(self, new: dict[str, bytes]) -> None:
        """Hold the memory's size: once full it keeps what it has, and begins anew now and then."""
        if len(self.known) + len(new) <= self.most:
            self.known.update(new)
        else:
            self.full += 1
            if self.full % 50 == 0:
                self.known.clear()

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (no nulls) end to end, and where each text's end; ``end`` is put behind each text."""
        whole = pc.match_substring_regex(texts, _BESIDE_SPACE)
        for s in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, s))
        apart = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        cut = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        offsets = cut.offsets.to_numpy().astype(np.int64)
        # a null is no piece: it stands for the first one of each text, and for the end
        pieces = cut.values.dictionary_encode()
        index = pieces.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        distinct = pieces.dictionary.to_pylist()
        known = self.known
        held = [known.get(p) for p in distinct]
        missing = [k for k, ids in enumerate(held) if ids is None and distinct[k]]
        learnt = self._learn([distinct[k] for k in missing])
        for k in missing:
            held[k] = learnt[distinct[k]]
        held = [b"" if ids is None else ids for ids in held]
        firsts = [distinct[k] for k in index[offsets[:-1]]]
        heads = dict.fromkeys(firsts)
        heads.update(zip(heads, self._whole(list(heads)), strict=True))
        head_ids = [heads[p] for p in firsts]
        for k, ids in zip(apart.tolist(), self._whole([texts[k].as_py() for k in apart.tolist()]), strict=True):
            head_ids[k] = ids
        index[offsets[:-1]] = len(held) + np.arange(len(firsts))
        held += head_ids
        if end is not None:
            index = np.insert(index, offsets[1:], len(held))
            offsets = offsets + np.arange(len(offsets))
            held.append(np.array([end], "<u4").tobytes())
        sizes = np.fromiter(map(len, held), np.int64, len(held)) // 4
        flat = np.frombuffer(b"".join(held), "<u4")
        starts = np.cumsum(sizes) - sizes
        many = sizes[index]
        ends = np.cumsum(many)
        at = np.repeat(starts[index] - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)
        self._remember(learnt)
        return flat[at], np.concatenate([[0], ends])[offsets[1:]]


def encoder(name: str) -> Encoder:
    """One encoder for each Python worker and vocabulary."""
    if name not in _LOADED:
        _LOADED[name] = Encoder(name)
    return _LOADED[name]
