"""SentencePiece encoding and decoding by a batched numpy Viterbi pass.

Texts are cut into units (a run of word marks and what follows, since no piece has a mark after another character); distinct
units of equal length advance together, one character a step (where few share a length, with those of lengths next to it). At each step the hashes of the substrings that end there probe
the sorted piece keys; a candidate piece scores by its length if it may follow the best piece that ends where it begins, and
minus infinity otherwise; the vectorised maximum is stored as a backpointer.

The model is a merge model (BPE), whose result isn't the one of largest score sum. The transition rule makes the pass exact:
a piece may follow another iff merging the two pieces' characters alone gives just these two pieces, and for every prefix
exactly one last piece meets the rule. ``test_pieces_match_the_library`` holds ids against the sentencepiece library. Of units
that begin with two marks or more, the marks before the last, whose pieces tie in score, are merged directly.

Characters without a piece become byte pieces. Decoding joins pieces, turns marks into spaces, drops the dummy prefix and reads
byte pieces as UTF-8 (what isn't valid becomes U+FFFD).

Nulls: a null text is empty and has no ids. Any length is encoded whole. Repeated rows are rows like others; an empty table
gives an empty one; ids of documents are cast to long; columns besides those named are ignored by the query and carried by ``encode_documents``.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.base import load, text_of
from driftline.llm.token_files import batches_of
from driftline.llm.wordcache import TRAIL, UnitEncoder

MODEL = "piece_bpe_32k.model"
MARK = "▁"
_UNITS = re.compile(f"{MARK}*[^{MARK}]*")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_PAIR_BITS = 20
#: Groups of fewer equal-length units are walked without numpy.
FEW = 12
#: Bytes of text that a task encodes at a time.
SLICE = 1_500_000
_MODELS: dict[tuple[str, int], PieceModel] = {}


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(MODEL))


def model(path: str, units: int = 120_000) -> PieceModel:
    """The worker's model; its caches live as long as the worker. units: distinct units whose ids it keeps."""
    if (path, units) not in _MODELS:
        _MODELS[path, units] = PieceModel(path, units)
    return _MODELS[path, units]


def _hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the last n characters of each row (rows, length): a polynomial, then mixed."""
    h = np.zeros(len(codes), np.uint64)
    for j in range(codes.shape[1] - n, codes.shape[1]):
        h = h * _BASE + codes[:, j] + np.uint64(1)
    return _mixed(h)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


class PieceModel:
    def __init__(self, path: str, units: int):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        kinds = pb.ModelProto.SentencePiece
        self.surface = [p.piece for p in proto.pieces]
        self.score = {p.piece: p.score for p in proto.pieces if p.type in (kinds.NORMAL, kinds.USER_DEFINED, kinds.UNUSED)}
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.piece in self.score}
        self.byte = np.zeros(256, np.uint32)
        out = []
        for i, p in enumerate(proto.pieces):
            if p.type == kinds.BYTE:
                self.byte[int(p.piece[3:-1], 16)] = i
                out.append(bytes([int(p.piece[3:-1], 16)]))
            elif p.type == kinds.CONTROL:
                out.append(b"")
            elif p.type == kinds.UNKNOWN:
                out.append(proto.trainer_spec.unk_surface.encode())
            else:
                out.append(p.piece.replace(MARK, " ").encode())
        self.out_len = np.fromiter(map(len, out), np.int64, len(out))
        self.out_at = np.cumsum(self.out_len) - self.out_len
        self.out = np.frombuffer(b"".join(out), np.uint8)
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("pieces with a word mark after another character are not supported")
        self.longest = max(map(len, self.id))
        # keys of the pieces by length, sorted, with a bitmap over their leading bits that rules out most other substrings
        self.keys: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in range(1, self.longest + 1):
            own = [p for p in self.id if len(p) == n and (n == 1 or self.merge(p) == [p])]
            if own:
                codes = np.array([[ord(c) for c in p] for p in own], np.uint64)
                h, ids = _hashes(codes, n), np.array([self.id[p] for p in own], np.int64)
                order = np.argsort(h)
                seen = np.zeros(1 << 20, bool)
                seen[(h >> np.uint64(44)).astype(np.int64)] = True
                if len(np.unique(h)) != len(h):
                    raise ValueError("two pieces share a key")
                self.keys[n] = (h[order], ids[order], seen)
        self.canonical = {p for p in self.id if len(p) == 1 or self.merge(p) == [p]}
        self.pair_key = np.full(1 << _PAIR_BITS, -1, np.int64)
        self.pair_ok = np.zeros(1 << _PAIR_BITS, bool)
        self.pairs: dict[tuple[str, str], bool] = {}
        # marks that trail a word may be cut off if no piece has such a mark after a letter or digit: no merge crosses there
        mixed = re.compile(f"[A-Za-z0-9À-ÖØ-öø-ÿ][{re.escape(TRAIL)}]")
        self.trim = not any(mixed.search(p) for p in self.id)
        self.units = UnitEncoder(self.encode_units, units)

    def merge(self, unit: str) -> list[str]:
        """The model's rule on a short string: merge the neighbours whose union scores best, the leftmost of equals, until none is a piece."""
        parts = list(unit)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether piece ``right`` may follow piece ``left`` (-1: nothing before it)."""
        pair = left * np.int64(1 << 20) + right
        slot = ((pair.view(np.uint64) * _MIX) >> np.uint64(64 - _PAIR_BITS)).astype(np.int64)
        ok = self.pair_ok[slot]
        miss = np.flatnonzero((self.pair_key[slot] != pair) & (left >= 0))
        if len(miss):
            distinct, first, back = np.unique(pair[miss], return_index=True, return_inverse=True)
            a, b = left[miss][first], right[miss][first]
            said = np.fromiter((self.pair(self.surface[x], self.surface[y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)), bool, len(a))
            ok[miss] = said[back]
            self.pair_key[slot[miss]], self.pair_ok[slot[miss]] = pair[miss], said[back]
        return ok | (left < 0)

    def pair(self, a: str, b: str) -> bool:
        return self.merge(a + b) == [a, b]

    def _fallback(self, c: str) -> list[int]:
        return self.byte[list(c.encode("utf-8", "replace"))].tolist()

    def _scalar(self, unit: str) -> np.ndarray:
        """The same pass over one unit, without numpy."""
        last, n = [None] * (len(unit) + 1), len(unit)
        for i in range(1, n + 1):
            for length in range(min(self.longest, i), 0, -1):
                p, before = unit[i - length : i], last[i - length]
                if p in self.canonical and (before is None or self._known(before, p)):
                    last[i] = p
                    break
            else:
                last[i] = None  # a character without a piece: what follows begins anew
        ids, i = [], n  # from the end
        while i:
            if last[i] is None:
                ids += reversed(self._fallback(unit[i - 1]))
                i -= 1
            else:
                ids.append(self.id[last[i]])
                i -= len(last[i])
        return np.array(ids[::-1], np.uint32)

    def _known(self, a: str, b: str) -> bool:
        if (a, b) not in self.pairs:
            if len(self.pairs) > 50_000:
                self.pairs.clear()
            self.pairs[a, b] = self.pair(a, b)
        return self.pairs[a, b]

    def _viterbi(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Units of one length, or of lengths so alike that shorter ones go along to the end: all ids and each unit's number of them."""
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        k, n = len(units), int(sizes.max())
        codes = np.frombuffer("".join(u.ljust(n, "\0") for u in units).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(k, n).astype(np.uint64)
        prefix = np.zeros((n + 1, k), np.uint64)
        for j in range(n):
            prefix[j + 1] = prefix[j] * _BASE + codes[:, j] + np.uint64(1)
        power = np.array([pow(int(_BASE), j, 1 << 64) for j in range(self.longest + 1)], np.uint64)
        last = np.full((n + 1, k), -1, np.int64)  # the piece that ends there; -1: none, or a character without a piece
        step = np.zeros((n + 1, k), np.int64)
        for i in range(1, n + 1):
            best = np.zeros(k, np.int64)
            for length in range(1, min(self.longest, i) + 1):
                if length not in self.keys:
                    continue
                keys, ids, seen = self.keys[length]
                h = _mixed(prefix[i] - prefix[i - length] * power[length])
                rows = np.flatnonzero(seen[(h >> np.uint64(44)).astype(np.int64)])
                at = np.minimum(np.searchsorted(keys, h[rows]), len(keys) - 1)
                there = keys[at] == h[rows]
                rows, piece = rows[there], ids[at[there]]
                if not len(rows):
                    continue
                score = np.where(self.follows(last[i - length, rows], piece), length, -1)
                wins = score > best[rows]
                rows, piece = rows[wins], piece[wins]
                best[rows], last[i, rows], step[i, rows] = length, piece, length
            step[i, best == 0] = 1
        ends = sizes.copy()
        back: list[np.ndarray] = []
        rows_at: list[np.ndarray] = []
        live = np.arange(k)
        while len(live):
            at = ends[live]
            piece = last[at, live]
            back.append(np.where(piece >= 0, piece, -1 - codes[live, at - 1].astype(np.int64)))
            rows_at.append(live)
            ends[live] = at - step[at, live]
            live = live[ends[live] > 0]
        rows, found = np.concatenate(rows_at[::-1]), np.concatenate(back[::-1])
        order = np.argsort(rows, kind="stable")
        found, counts = found[order], np.bincount(rows, minlength=k)
        if (found >= 0).all():
            return found.astype(np.uint32), counts
        parts = [[x] if x >= 0 else self._fallback(chr(-1 - x)) for x in found.tolist()]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        return np.array([y for p in parts for y in p], np.uint32), np.add.reduceat(sizes, np.cumsum(counts) - counts)

    def _batches(self, lengths: np.ndarray):
        """Rows of rising lengths in batches: 50,000 of one length at most; FEW of one length or less go with neighbours up to half as long again."""
        edges = np.r_[np.flatnonzero(np.r_[True, lengths[1:] != lengths[:-1]]), len(lengths)] if len(lengths) else np.zeros(1, np.int64)
        few = 0  # where rows begin that wait for neighbours
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if few < a and (b - a >= FEW or lengths[a] > 1.5 * lengths[few]):
                yield few, a
                few = a
            if b - a >= FEW:
                yield from ((at, min(at + 50_000, b)) for at in range(a, b, 50_000))
                few = b
        if few < len(lengths):
            yield few, len(lengths)

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids and each unit's number of them, for units that aren't empty.

        Of a unit with several marks, the last one and the word go through the pass as usual, since these pieces score above
        runs of marks; what marks are left merge from the left.
        """
        marks = np.fromiter((len(u) - len(u.lstrip(MARK)) if u.startswith(MARK + MARK) else 1 for u in units), np.int64, len(units))
        cores = [u[m - 1 :] if m > 1 else u for u, m in zip(units, marks.tolist(), strict=True)]
        chars = np.fromiter(map(len, cores), np.int64, len(units))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # units, ids, numbers
        order = np.argsort(chars, kind="stable")
        for a, b in self._batches(chars[order]):
            rows = order[a:b]
            texts = [cores[i] for i in rows.tolist()]
            if len(rows) < FEW:  # a pass over so few, of which one may be very long, is faster without numpy
                each = [self._scalar(t) for t in texts]
                found.append((rows, np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each))))
            else:
                found.append((rows, *self._viterbi(texts)))
        heads: dict[int, np.ndarray] = {}  # ids of the marks before a unit's own
        drop = np.zeros(len(units), np.int64)  # 1: the unit's last mark stands alone and belongs to the run
        many = marks > 1
        for rows, ids, n in found if many.any() else ():
            first = ids[np.cumsum(n) - n]
            for i, x in zip(rows[many[rows]].tolist(), first[many[rows]].tolist(), strict=True):
                drop[i] = self.surface[x] == MARK
                heads[i] = np.array([self.id[p] for p in self._merged_run(int(marks[i] - 1 + drop[i]))], np.uint32)
        size = np.zeros(len(units), np.int64)
        size[list(heads)] = [len(h) for h in heads.values()]
        lens = np.zeros(len(units), np.int64)
        for rows, _, n in found:
            lens[rows] = n - drop[rows] + size[rows]
        begin = np.cumsum(lens) - lens
        out = np.zeros(int(lens.sum()) + 1, np.uint32)  # with a place for what is dropped
        for rows, ids, n in found:
            ends = np.cumsum(n)
            at = np.repeat(begin[rows] + size[rows] - drop[rows] - (ends - n), n) + np.arange(len(ids))
            gone = (ends - n)[drop[rows] > 0]
            at[gone] = len(out) - 1
            out[at] = ids
        for i, head in heads.items():
            out[begin[i] : begin[i] + len(head)] = head
        return out[:-1], lens

    def _merged_run(self, n: int) -> list[str]:
        if n <= 512:
            return self.merge(MARK * n)
        # equal scores merge from the left: the first pieces of a long run are whole ones, so only its end differs
        whole = max((len(p) for p in self.id if not p.strip(MARK)), default=1)
        head = self.merge(MARK * 512)
        if any(len(p) != whole for p in head[:8]):
            return self.merge(MARK * n)
        cut = (n - 256) // whole
        return [MARK * whole] * cut + self.merge(MARK * (n - cut * whole))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin."""
        odd = pc.any(pc.match_substring_regex(texts, f"{MARK}|  |^ | $")).as_py()
        if odd:
            lists = [_UNITS.findall(MARK + t.replace(" ", MARK))[:-1] if t else [] for t in texts.to_pylist()]
            return self.units(pa.array([u for x in lists for u in x], pa.string()), np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int64))
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy()
        words = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets = offsets - offsets[0]
        full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)  # an empty text gives one empty word
        if not full.all():
            words, offsets = words.filter(pa.array(full)), np.r_[0, np.cumsum(full)][offsets]
        return self.units(pc.binary_join_element_wise(pa.scalar(MARK), words, ""), offsets, self.trim)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of the id lists that begin at the offsets."""
        n = self.out_len[ids]
        ends = np.cumsum(n)
        data = self.out[np.repeat(self.out_at[ids] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        at = np.r_[0, ends][offsets].tolist()
        out = []
        for a, b in zip(at[:-1], at[1:], strict=True):
            text = data[a:b].decode("utf-8", "replace")
            out.append(text.removeprefix(" "))
        return out


def encode_documents(docs: DataFrame, text_col: str = "text", model_path: str | None = None, out_col: str = "ids", check_col: str | None = None) -> DataFrame:
    """All columns and ``ids`` array<int>; check_col: whether the ids decode to the text."""
    path = model_path or default_model()
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in batches_of(batch, SLICE, at):
                texts = pc.fill_null(part.column(at).cast(pa.string()), "")
                ids, offsets = model(path).encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.view(np.int32)))
                checked = [pc.equal(pa.array(model(path).decode(ids, offsets), pa.string()), texts)] if check_col else []
                yield pa.RecordBatch.from_arrays([*part.columns, lists, *checked], names=[*part.schema.names, out_col, *([check_col] if check_col else [])])

    extra = [T.StructField(out_col, T.ArrayType(T.IntegerType())), *([T.StructField(check_col, T.BooleanType())] if check_col else [])]
    return docs.mapInArrow(run, T.StructType([*(T.StructField(f.name, f.dataType) for f in docs.schema.fields), *extra]))


def decode_documents(encoded: DataFrame, ids_col: str = "ids", model_path: str | None = None, out_col: str = "decoded") -> DataFrame:
    """All columns and ``decoded``, the text that the ids stand for; null ids are read as none."""
    path = model_path or default_model()
    at = encoded.columns.index(ids_col)

    def run(batches):
        for batch in batches:
            lists = pc.fill_null(batch.column(at), pa.scalar([], pa.list_(pa.int32())))
            offsets = lists.offsets.to_numpy()
            ids = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
            texts = model(path).decode(ids, offsets - offsets[0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out_col])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(out_col, T.StringType())]))


def digests(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """(doc_id, text) -> doc_id, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers), decoded_sha256, round_trip: encodes and decodes in one pass."""
    path = model_path or default_model()

    def run(batches):
        for batch in batches:
            for part in batches_of(batch, 4 * SLICE):
                ids, offsets = model(path, 500_000).encode(part.column(1))
                flat, at = ids.astype("<u4"), offsets.tolist()
                crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                decoded = model(path, 500_000).decode(ids, offsets)
                sha = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded])
                same = pc.equal(pa.array(decoded, pa.string()), part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64()), sha, same], names=["doc_id", "n_tokens", "ids_crc32", "decoded_sha256", "round_trip"])

    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, round_trip boolean")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(load(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")))
