"""SentencePiece encoding and decoding with an Aho-Corasick automaton and a single-pass Viterbi.

The automaton holds every piece of a model. One pass over a text follows its output links: each piece
that ends at a position relaxes the best score there, a sum of piece scores. A character that is a
piece of no kind costs the lowest score less ten and is written as its UTF-8 bytes.

Blanks are written as the mark U+2581, with one in front of the text. No piece has a mark behind
another character, so a mark behind one is always a cut, and what stands between cuts is encoded on
its own and remembered. So is a letter before a mark of punctuation that no piece has behind a letter.
Chunks not yet known are segmented together: one pass of the automaton over all of them, and the
relaxation of a position is done for all chunks at once. A mark in the text itself is written as bytes, so decoding gives back every
text exactly.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.words import kept

MARK = "▁"
#: Chunks that each of a worker's two generations of remembered ones holds; characters of a chunk that
#: is segmented with others; characters of the texts that are encoded together.
REMEMBERED, SHORT, TOGETHER = 100_000, 48, 400_000
#: In place of a piece's id: a character of no piece; the place in front of a chunk.
UNKNOWN, NO_PLACE = -1, -2


def load(model_file: str) -> dict:
    """The pieces of a model file: {piece: (id, score)}, byte ids, and what decoding writes for each id."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model_file)
    pieces, by_byte, written = {}, {}, []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            by_byte[int(piece[3:5], 16)] = i
            written.append(bytes([int(piece[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            written.append(b"")
        else:
            pieces[piece] = (i, sp.get_score(i))
            written.append(piece.replace(MARK, " ").encode())
    if len(by_byte) < 256:
        raise ValueError("the model has no piece for every byte")
    if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
        raise ValueError("a piece has a mark behind another character")
    return {"pieces": pieces, "bytes": [by_byte[b] for b in range(256)], "written": written}


class Encoder:
    def __init__(self, model: dict):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, (i, score) in model["pieces"].items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.bytes = model["bytes"]
        self.unknown = min((s for _, s in model["pieces"].values()), default=0.0) - 10
        sizes, scores = np.zeros(len(model["written"]), np.int64), np.zeros(len(model["written"]))
        for piece, (i, score) in model["pieces"].items():
            sizes[i], scores[i] = len(piece), score
        self.sizes, self.scores = sizes, scores
        behind = {b for piece in model["pieces"] for a, b in zip(piece, piece[1:]) if a.isalpha()}
        cut = "".join(re.escape(c) for c in ",.;:!?#$%&*|" if c not in behind) or MARK
        self.chunks = re.compile(f"{MARK}*+[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[{cut}])|{MARK}*+[^{MARK}]++|{MARK}++").findall
        used = {c for piece in model["pieces"] for c in piece}
        self.apart = next(chr(c) for c in range(0x10FFFF) if chr(c) not in used)
        self.mark = np.array([self.bytes[b] for b in MARK.encode()], "<i4").tobytes()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def viterbi(self, chunk: str) -> list[int]:
        """Ids of the best segmentation; of equal scores the one whose last piece is longer."""
        n = len(chunk)
        best: list[float | None] = [0.0] + [None] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        done = 0

        def unknown(upto: int) -> None:
            """A position that no piece of one character reaches can be reached by an unknown one."""
            for p in range(done + 1, upto + 1):
                if not single[p]:
                    score = best[p - 1] + self.unknown
                    if best[p] is None or score > best[p]:
                        best[p], back[p] = score, (p - 1, -1)

        single = [False] * (n + 1)
        for end, i in self.automaton.iter(chunk):
            p, size, score = end + 1, int(self.sizes[i]), float(self.scores[i])
            if p > done + 1:
                unknown(p - 1)
                done = p - 1
            total = best[p - size] + score
            if best[p] is None or total > best[p]:
                best[p], back[p] = total, (p - size, i)
            if size == 1:
                single[p] = True
        unknown(n)
        out: list[int] = []
        p = n
        while p > 0:
            q, i = back[p]
            if i >= 0:
                out.append(i)
            else:
                out.extend(self.bytes[b] for b in reversed(chunk[q:p].encode("utf-8", "surrogatepass")))
            p = q
        return out[::-1]

    def segment(self, chunks: list[str]) -> list[list[int]]:
        """`viterbi` of many short chunks."""
        return [list(struct.unpack(f"<{len(ids) // 4}i", ids)) for ids in self.segmented(chunks)]

    def segmented(self, chunks: list[str]) -> list[bytes]:
        """`segment`, relaxed a position at a time for all chunks; ids are packed, 4 bytes each."""
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        start = np.cumsum(np.append(0, size + 1))[:-1]
        found = np.fromiter(chain.from_iterable(self.automaton.iter(self.apart.join(chunks))), np.int64).reshape(-1, 2)
        place, piece = found[:, 0] + 1, found[:, 1]  # a place is behind its character
        at = place - start[np.searchsorted(start, place, "left") - 1]
        order = np.argsort(at, kind="stable")
        place, piece = place[order], piece[order]
        ends = np.searchsorted(at[order], np.arange(int(size.max()) + 2))
        best = np.full(int(size.sum()) + len(chunks) + 1, -np.inf)
        back, chosen = np.zeros(len(best), np.int64), np.full(len(best), UNKNOWN)
        best[start], chosen[start] = 0.0, NO_PLACE
        for p in range(1, int(size.max()) + 1):
            g, i = place[ends[p] : ends[p + 1]], piece[ends[p] : ends[p + 1]]
            if len(g):
                total = best[g - self.sizes[i]] + self.scores[i]
                first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
                most = np.maximum.reduceat(total, first)
                hit = np.flatnonzero(total == np.repeat(most, np.diff(np.append(first, len(g)))))
                hit = hit[np.append(True, g[hit][1:] != g[hit][:-1])]  # the longest of equals comes first
                best[g[hit]], back[g[hit]], chosen[g[hit]] = total[hit], g[hit] - self.sizes[i[hit]], i[hit]
            every = start[size >= p] + p
            every = every[~np.isin(every, g[self.sizes[i] == 1])] if len(g) else every
            unknown = best[every - 1] + self.unknown
            every, unknown = every[unknown > best[every]], unknown[unknown > best[every]]
            best[every], back[every], chosen[every] = unknown, every - 1, UNKNOWN
        # the best ways back, a piece at a time for all chunks; in order, the places on them spell the ids
        passed = np.zeros(len(best), bool)
        g = start + size
        while len(g := g[chosen[g] != NO_PLACE]):
            passed[g] = True
            g = back[g]
        places = np.flatnonzero(passed)
        ids = chosen[places]
        until = np.searchsorted(places, start + size, "right")
        from_ = np.append(0, until[:-1])
        whole, ends = ids.astype("<i4").tobytes(), (until * 4).tolist()
        out = [whole[lo:hi] for lo, hi in zip([0, *ends[:-1]], ends)]
        for k in np.unique(np.searchsorted(until, np.flatnonzero(ids == UNKNOWN), "right")).tolist():
            own = zip(places[from_[k] : until[k]].tolist(), ids[from_[k] : until[k]].tolist())
            out[k] = b"".join([struct.pack("<i", i) if i >= 0 else self.spelt(chunks[k][p - 1 - int(start[k])]) for p, i in own])
        return out

    def spelt(self, character: str) -> bytes:
        """Packed ids of a character's UTF-8 bytes."""
        return struct.pack(f"<{len(b := character.encode('utf-8', 'surrogatepass'))}i", *[self.bytes[x] for x in b])

    def encode(self, text: str | None) -> bytes:
        """Packed ids, 4 bytes each; null and empty texts have none."""
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """`encode` of each text; what none of them has been seen with is segmented together."""
        # a text's parts stand between marks of its own; the first has a blank in front
        parts = [[self.chunks((MARK * (not k) + part).replace(" ", MARK)) for k, part in enumerate(t.split(MARK))] if t else [] for t in texts]
        new = set(chain.from_iterable(chain.from_iterable(parts)))
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        new = new.difference(self.known)
        self.known.update([(c, self.older[c]) for c in new if c in self.older])
        new = new.difference(self.known)
        short = sorted((c for c in new if len(c) <= SHORT), key=len)
        if short:
            self.known.update(zip(short, self.segmented(short)))
        own_ids = self.known.__getitem__
        if len(short) < len(new):  # long chunks are not remembered
            long = {c: struct.pack(f"<{len(ids)}i", *ids) for c, ids in ((c, self.viterbi(c)) for c in new if len(c) > SHORT)}
            own_ids = lambda c: self.known.get(c) or long[c]
        return [self.mark.join([b"".join(map(own_ids, part)) for part in own]) for own in parts]


def decode_ids(ids: list[int], written: list[bytes]) -> str:
    """The text of a list of ids, without the blank put in front."""
    return b"".join([written[i] for i in ids]).decode("utf-8", "replace")[1:]


class Decoder:
    def __init__(self, written: list[bytes]):
        self.written = written
        self.sizes = np.fromiter(map(len, written), np.int64, len(written))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(written), np.uint8)

    def decode_many(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """`decode_ids` of lists that stand in a row in `ids`, each up to its place of `ends`.

        The pieces of all of them are copied at once.
        """
        size, upto = self.sizes[ids], np.cumsum(self.sizes[ids])
        place = np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(self.starts[ids] - upto + size, size)
        whole = self.bytes[place].tobytes()
        cuts = np.append(0, upto)[ends].tolist()
        return [whole[lo:hi].decode("utf-8", "replace")[1:] for lo, hi in zip([0, *cuts[:-1]], cuts)]


def _encoded(encoder: Encoder, batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str | None], pa.ListArray]]:
    """Rows, texts and ids of (row, text), TOGETHER characters at a time."""
    rows, lo, texts, held = batch.column(0), 0, [], 0
    for k, t in enumerate(batch.column(1), 1):
        texts.append(t.as_py())
        held += len(texts[-1] or "")
        if held > TOGETHER or k == len(rows):
            packed = encoder.encode_many(texts)
            ends = np.append(0, np.cumsum([len(p) // 4 for p in packed])).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(packed), "<i4"))
            yield rows.slice(lo, k - lo), texts, pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array([t is None for t in texts]))
            lo, texts, held = k, [], 0


def encode(docs: DataFrame, model: dict, text: str = "text", to: str = "ids") -> DataFrame:
    """`docs` and the column `to`, array<int>: the ids of each whole text.

    Null texts have null ids, empty ones an empty list. A column of that name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the vocabulary's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for rows, _, ids in _encoded(encoder, batch):
                yield pa.RecordBatch.from_arrays([rows, ids], names=["row", "ids"])

    return _mapped(docs, docs[text], run, to, "ids", T.ArrayType(T.IntegerType()))


def decode(docs: DataFrame, model: dict, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """`docs` and the column `to`, string: the text of each list of ids; null for null, empty for none."""
    shared = docs.sparkSession.sparkContext.broadcast(model["written"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = shared.value
        for batch in batches:
            rows, lo, texts, held = batch.column(0), 0, [], 0
            for k, own in enumerate(batch.column(1), 1):
                texts.append(decode_ids(own.values.to_pylist(), written) if own.is_valid else None)
                held += len(texts[-1] or "")
                if held > 1 << 23 or k == len(rows):
                    yield pa.RecordBatch.from_arrays([rows.slice(lo, k - lo), pa.array(texts, pa.string())], names=["row", "text"])
                    lo, texts, held = k, [], 0

    return _mapped(docs, docs[ids], run, to, "text", T.StringType())


def round_trips(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids array<int>, n_decoded long and returned boolean: `encode` and `decode` of each whole text in one pass.

    n_decoded is the length of the text that the ids decode to, returned whether it is the text
    itself. A null text has null ids, decodes to null, and counts as returned. The texts themselves
    do not leave the task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = "pieces " + hashlib.sha256(repr((model["pieces"], model["bytes"], model["written"])).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = kept(key, lambda: (Encoder(shared.value), Decoder(shared.value["written"])))
        for batch in batches:
            for rows, texts, ids in _encoded(encoder, batch):
                decoded = decoder.decode_many(ids.values.to_numpy(), ids.offsets.to_numpy()[1:])
                size = pa.array([None if t is None else len(d) for t, d in zip(texts, decoded)], pa.int64())
                same = pa.array([t is None or t == d for t, d in zip(texts, decoded)])
                yield pa.RecordBatch.from_arrays([rows, ids, size, same], names=["doc_id", "ids", "n_decoded", "returned"])

    source = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return source.mapInArrow(run, T.StructType([source.schema["doc_id"], *T._parse_datatype_string("ids array<int>, n_decoded long, returned boolean").fields]))


def _mapped(docs: DataFrame, source, run, to: str, made: str, kind: T.DataType) -> DataFrame:
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns if c != to] or [F.lit(1)]).alias("row"), source.alias("source"))
    out = rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField(made, kind)]))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != to], F.col(made).alias(to))
