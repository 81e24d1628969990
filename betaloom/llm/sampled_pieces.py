"""Sampled segmentations over a SentencePiece vocabulary, and lossless decoding.

A text begins with a blank that stands for none, and is cut into chunks, each a run of blanks with the
characters up to the next. The pieces that fit a chunk make a lattice. Forward filtering sums the weights of all
paths to each position; backward sampling starts at the end and takes each piece with its share of that sum, so a
segmentation is drawn with its probability. The vocabulary is one of merges and has ranks, no probabilities, so
a piece's weight is 1 / (rank + 1) to the power ``alpha``. A character in no piece goes as its UTF-8 bytes. The draws are a
function of the seed, the row's key and the place of the piece alone: the same row gives the same pieces in any partition.

Lattices are built for all distinct chunks of a batch at once with array operations, and kept in a store of fixed size for
the batches after it; all chunks of a batch are sampled together, one piece a step. Shares are rounded to 2**-40. Null and empty texts have no pieces. Rows that share a key and text get the same pieces; a null key is a key like any other. An
empty table gives no rows. A blank sign in the text itself goes as bytes, so decoding gives back every text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.llm.tokens import CODES, SpanHash, code_points, mix64, text_batches

BLANK = 0x2581
HIDDEN = CODES  # stands for a blank sign in the text; beyond all characters, so in no piece
ALPHA = 1.0
SHARE_BITS = 40
STORE_EDGES = 12_000_000  # a worker keeps so many edges of lattices it has built, 20 bytes each with their nodes


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Sampler:
    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.bytes_of = [b""] * self.size
        self.byte_id = np.zeros(256, np.int64)
        ids, texts = [], []
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.bytes_of[i] = piece.replace(chr(BLANK), " ").encode()
                if chr(BLANK) not in piece.lstrip(chr(BLANK)):
                    ids.append(i)
                    texts.append(piece)
        self.hash = SpanHash()
        codes = code_points("".join(texts))
        lengths = np.array([len(t) for t in texts])
        ends = np.cumsum(lengths)
        hashes = self.hash(codes, ends - lengths, ends)
        weight = -alpha * np.log1p(np.array([-model.get_score(i) for i in ids]).clip(0))
        self.fallback = -alpha * np.log1p(self.size) - 1.0
        self.maybe = np.zeros(1 << 20, bool)  # by the top bits of the hash: few spans that are no piece get past
        self.maybe[(hashes >> np.uint64(44)).astype(np.int64)] = True
        self.tables = {}
        for n in sorted(set(lengths.tolist())):
            own = np.flatnonzero(lengths == n)
            own = own[np.argsort(hashes[own])]
            self.tables[n] = hashes[own], np.array(ids)[own], weight[own]
        sizes = np.array([len(b) for b in self.bytes_of])
        self.byte_ends = np.cumsum(sizes)
        self.byte_sizes = sizes
        self.flat_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.forget()

    def lattice(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Nodes are positions 0..length of each chunk in a row. Returns each chunk's first node, the first edge of every node,
        and the edges by end node, longest piece first: their cumulative share in units of 2**-SHARE_BITS, start node and piece
        (or size + code point). Shares are whole numbers, so a chunk's lattice is the same in any company."""
        lengths = ends - starts
        base = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        owner = np.repeat(np.arange(len(starts)), lengths)
        at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        first, room = starts[owner] + at, lengths[owner] - at
        node = base[owner] + at
        found = []
        single = np.zeros(len(first), bool)
        for n, (hashes, ids, weight) in self.tables.items():
            some = np.flatnonzero(room >= n)
            if not len(some):
                continue
            h = self.hashed(codes, first[some], n)
            likely = self.maybe[(h >> np.uint64(44)).astype(np.int64)]
            some, h = some[likely], h[likely]
            place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = hashes[place] == h
            some, place = some[hit], place[hit]
            if n == 1:
                single[some] = True
            found.append((node[some], node[some] + n, at[some] + n, ids[place], weight[place]))
        bare = np.flatnonzero(~single)
        found.append((node[bare], node[bare] + 1, at[bare] + 1, self.size + codes[first[bare]].astype(np.int64), np.full(len(bare), self.fallback)))
        start, end, local, piece, weight = (np.concatenate(x) for x in zip(*found, strict=True))
        n_nodes = int((lengths + 1).sum())
        longest = max(self.tables) + 1
        order = np.argsort((local * n_nodes + end) * longest + (end - start))  # no two edges have the same key
        start, end, local, piece, weight = (x[order] for x in (start, end, local, piece, weight))
        alpha = np.zeros(n_nodes)
        cuts = np.flatnonzero(np.append(True, local[1:] != local[:-1])) if len(local) else np.empty(0, int)
        for a, b in zip(cuts, np.append(cuts[1:], len(local)), strict=True):
            # all edges that end at this distance from their chunk's start: their starts are done
            w = alpha[start[a:b]] + weight[a:b]
            new = np.flatnonzero(np.append(True, end[a + 1 : b] != end[a : b - 1]))
            most = np.maximum.reduceat(w, new)
            total = np.add.reduceat(np.exp(w - np.repeat(most, np.diff(np.append(new, b - a)))), new)
            alpha[end[a:b][new]] = most + np.log(total)
        share = np.rint(np.exp(alpha[start] + weight - alpha[end]) * (1 << SHARE_BITS)).astype(np.int64)
        order = np.argsort(end * longest + (longest - (end - start)))
        start, end, piece, share = start[order], end[order], piece[order], share[order]
        edge = np.cumsum(np.append(0, np.bincount(end, minlength=n_nodes)[:-1]))
        upto = np.cumsum(share)
        cumulative = upto - (upto - share)[edge[end]]
        # the last edge of a node takes what rounding left
        cumulative[np.append(end[1:] != end[:-1], True)] = 1 << SHARE_BITS
        return base, edge, cumulative, start, piece

    def remembered(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The first nodes of chunks (distinct hashes, in order) in the store of lattices; those not yet in it are added.

        A store of ``STORE_EDGES`` is begun anew: lattices are then built again, to the same values.
        """
        place = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        new = self.known[place] != hashes if len(self.known) else np.ones(len(hashes), bool)
        if new.any():
            base, edge, share, start, piece = self.lattice(codes, starts[new], ends[new])
            if self.edges + len(share) > len(self.share):
                if not new.all():
                    self.forget()
                    return self.remembered(codes, starts, ends, hashes)
                self.forget(max(len(share), STORE_EDGES))
            nodes, upto, edges = self.nodes, self.nodes + len(edge), self.edges
            if upto > len(self.edge):
                self.edge = np.concatenate([self.edge[:nodes], np.empty(max(upto, STORE_EDGES // 2), np.int64)])
            self.edge[nodes:upto] = edge + edges
            self.nodes, self.edges = upto, edges + len(share)
            self.share[edges : self.edges] = share
            self.start[edges : self.edges] = start + nodes
            self.piece[edges : self.edges] = piece
            known = np.concatenate([self.known, hashes[new]])
            order = np.argsort(known)
            self.known, self.base = known[order], np.concatenate([self.base, base + nodes])[order]
            place = np.searchsorted(self.known, hashes)
        return self.base[place]

    def forget(self, room: int = STORE_EDGES) -> None:
        """Begin the store anew. Its memory is used as it fills."""
        self.nodes = self.edges = 0
        self.known, self.base = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.edge, self.share = np.empty(room // 2, np.int64), np.empty(room, np.int64)
        self.start, self.piece = np.empty(room, np.int32), np.empty(room, np.int32)

    def hashed(self, codes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
        return self.hash.between(self.sums, starts, starts + n)

    def encode(self, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all texts in a row and the bounds of each text; ``keys`` are 64-bit, one a text."""
        joined = "".join(" " + t if t else "" for t in texts)
        codes = code_points(joined).copy()
        if not len(codes):
            return np.empty(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        codes[codes == BLANK] = HIDDEN
        codes[codes == 32] = BLANK
        lengths = np.fromiter((len(t) + 1 if t else 0 for t in texts), np.int64, len(texts))
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        blank = codes == BLANK
        new = blank & ~np.append(False, blank[:-1])
        new[bounds[:-1][lengths > 0]] = True
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(codes))
        self.sums = self.hash.sums(codes)
        hashes = self.hash.between(self.sums, starts, ends)
        distinct, example, chunk = np.unique(hashes, return_index=True, return_inverse=True)
        base = self.remembered(codes, starts[example], ends[example], distinct)[chunk]
        text = np.searchsorted(bounds, starts, side="right") - 1
        first_chunk = np.searchsorted(starts, bounds[:-1])
        with np.errstate(over="ignore"):
            state = mix64(keys[text] + (np.arange(len(starts)) - first_chunk[text]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        active, node = np.arange(len(starts)), base + (ends - starts)
        taken, step = [], 0
        while len(active):
            with np.errstate(over="ignore"):
                u = (mix64(state[active] + np.uint64(step)) >> np.uint64(64 - SHARE_BITS)).astype(np.int64)
            edge = self.edge[node]
            beyond = np.flatnonzero(self.share[edge] <= u)
            while len(beyond):
                edge[beyond] += 1
                beyond = beyond[self.share[edge[beyond]] <= u[beyond]]
            taken.append((active, self.piece[edge]))
            node = self.start[edge].astype(np.int64)
            going = node > base[active]
            active, node = active[going], node[going]
            step += 1
        count = np.zeros(len(starts), np.int64)
        for own, _ in taken:
            count[own] += 1
        upto = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(upto[-1], np.int64)
        for k, (own, pieces) in enumerate(taken):
            out[upto[own + 1] - 1 - k] = pieces
        cut = upto[np.searchsorted(starts, bounds)]
        return self._with_bytes(out, cut)

    def _with_bytes(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters in no piece become the ids of their bytes."""
        code = ids - self.size
        code[code == HIDDEN] = BLANK
        bare = code >= 0
        wide = np.where(bare, 1 + (code >= 0x80).astype(int) + (code >= 0x800) + (code >= 0x10000), 1)
        upto = np.concatenate([[0], np.cumsum(wide)])
        out = np.repeat(np.where(bare, 0, ids), wide)
        narrow = np.flatnonzero(bare & (wide == 1))
        out[upto[narrow]] = self.byte_id[code[narrow]]
        for i in np.flatnonzero(wide > 1).tolist():
            out[upto[i] : upto[i + 1]] = self.byte_id[list(chr(code[i]).encode("utf-8", "surrogatepass"))]
        return out, upto[bounds]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]

    def decoded(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """``decode`` of many rows of ids, with array operations."""
        sizes = self.byte_sizes[ids]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        data = self.flat_bytes[np.repeat(self.byte_ends[ids] - upto[1:], sizes) + np.arange(upto[-1])].tobytes()
        cut = upto[bounds].tolist()
        return [data[a:b].decode("utf-8", "surrogatepass")[1:] for a, b in zip(cut, cut[1:], strict=False)]


_samplers: dict[tuple[str, float], Sampler] = {}


def sampler(path: str, alpha: float = ALPHA) -> Sampler:
    if (path, alpha) not in _samplers:
        _samplers[path, alpha] = Sampler(path, alpha)
    return _samplers[path, alpha]


def row_key(seed: int, key: object) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed}:{key}".encode(), digest_size=8).digest(), "little")


def encode(docs: DataFrame, key: str = "doc_id", seed: int = 0, alpha: float = ALPHA, model: str | None = None, digests: bool = False) -> DataFrame:
    """Per row: key (as text), ids, n_pieces, ids_crc32 (little-endian 32-bit) and lossless (whether decoding gives back the whole text).

    ``digests`` leaves the ids out.
    """
    path = model or default_model()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sampler(path, alpha)
        for frame in frames:
            texts = [t if isinstance(t, str) else "" for t in frame["text"]]
            low = 0
            for batch in text_batches(texts):
                names = frame["key"].iloc[low : low + len(batch)].tolist()
                keys = np.array([row_key(seed, n) for n in names], np.uint64)
                ids, bounds = own.encode(batch, keys)
                rows = [ids[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
                out = {
                    "key": names,
                    "n_pieces": [len(r) for r in rows],
                    "ids_crc32": [zlib.crc32(r.astype("<u4").tobytes()) for r in rows],
                    "lossless": [back == t for back, t in zip(own.decoded(ids, bounds), batch, strict=True)],
                }
                if not digests:
                    out["ids"] = [r.astype(np.int32) for r in rows]
                yield pd.DataFrame(out)
                low += len(batch)

    schema = "key string, n_pieces long, ids_crc32 long, lossless boolean" + ("" if digests else ", ids array<int>")
    return docs.select(F.col(key).cast("string").alias("key"), "text").mapInPandas(run, schema)


def decode(rows: DataFrame, ids: str = "ids", model: str | None = None) -> DataFrame:
    """All columns of ``rows`` and the ``text`` that the pieces in ``ids`` stand for; null ids give null."""
    path = model or default_model()

    @F.pandas_udf("string")
    def texts(column: pd.Series) -> pd.Series:
        own = sampler(path)
        return pd.Series([None if x is None else own.decode(list(x)) for x in column], dtype=object)

    return rows.select(*[c for c in rows.columns if c != "text"], texts(ids).alias("text"))
