"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

A token sequence is the merge result of a text exactly when each pair of neighbours is the merge result of its own
bytes. So the last token of every prefix follows from the last tokens of shorter prefixes. A state of the transducer is
the token before the pending bytes plus those bytes; reading a byte extends it, and tokens leave as soon as every
boundary that a vocabulary entry could still cross agrees on them, so lookahead never exceeds the longest entry. States
and transitions are made when first needed until ``most`` states exist; beyond them the same walk goes on without
making states.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

_STATES = 30_000  # states of a transducer
_PAIRS = 600_000  # pairs of neighbours remembered
_PIECES = 500_000  # pieces remembered


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


class _State:
    __slots__ = ("left", "pending", "last", "live", "next")

    def __init__(self, left: int, pending: bytes, last: tuple[int, ...], live: tuple[tuple[int, dict], ...]):
        self.left, self.pending, self.last, self.live, self.next = left, pending, last, live, {}


class Transducer:
    """Merge ranks as a transducer over bytes; ``encode`` takes one piece of the splitting pattern.

    A state's ``last`` holds the last token of each prefix of its pending bytes, ``live`` the boundaries that an entry
    of the vocabulary could still start from, each with the part of the prefix tree that lies ahead.
    """

    def __init__(self, ranks: dict[bytes, int], most: int = _STATES):
        self.ranks, self.most = ranks, most
        self.tokens = {v: k for k, v in ranks.items()}
        self.size = {v: len(k) for k, v in ranks.items()}
        self.root: dict[int, list] = {}  # prefix tree: byte to [entry that ends here or -1, the tree below or None]
        for text, rank in ranks.items():
            below = self.root
            for byte in text[:-1]:
                node = below.setdefault(byte, [-1, None])
                if node[1] is None:
                    node[1] = {}
                below = node[1]
            below.setdefault(text[-1], [-1, None])[0] = rank
        self.fits: dict[int, bool] = {}
        self.edges: dict[int, tuple | None] = {}
        self.states: dict[tuple[int, bytes], _State] = {}
        self.start = self.state(-1, b"", (), ((0, self.root),))

    def state(self, left: int, pending: bytes, last: tuple[int, ...], live: tuple[tuple[int, dict], ...]) -> _State:
        found = self.states.get((left, pending))
        if found is None:
            found = self.states[left, pending] = _State(left, pending, last, live)
        return found

    def merges(self, text: bytes) -> tuple[list[bytes], tuple[bytes, bytes] | None]:
        """Parts after all merges, lowest rank first and leftmost on ties, and the last pair merged."""
        parts, pair = [text[i : i + 1] for i in range(len(text))], None
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 62:
                break
            pair = parts[at], parts[at + 1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts, pair

    def edge(self, t: int):
        """Nodes along the right and the left side of an entry's merge tree, each as (bytes, rank when it appears, rank
        when it is used up), and whether ranks rise along both; None for an entry that merges never reach."""
        if t not in self.edges:
            text = self.tokens[t]
            parts, pair = self.merges(text)
            if parts != [text]:
                self.edges[t] = None
            elif pair is None:
                own = [(text, -1, 1 << 62)]
                self.edges[t] = own, own, True
            else:
                sides = []
                rises = True
                for k, side in ((1, 0), (0, 1)):
                    below = self.edge(self.ranks[pair[k]])
                    nodes = [*below[side][:-1], (*below[side][-1][:2], t), (text, t, 1 << 62)]
                    rises = rises and below[2] and all(x[1] < x[2] for x in nodes)
                    sides.append(nodes)
                self.edges[t] = sides[0], sides[1], rises
        return self.edges[t]

    def neighbours(self, a: int, b: int) -> bool:
        """Whether no merge crosses the boundary between two entries."""
        key = a << 32 | b
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > _PAIRS:
                self.fits.clear()
            left, right = self.edge(a), self.edge(b)
            if left[2] and right[2]:
                known = True
                for x, since_x, until_x in left[0]:
                    for y, since_y, until_y in right[1]:
                        m = self.ranks.get(x + y)
                        if m is not None:
                            at = max(m, since_x, since_y)
                            if at < until_x and at <= until_y:
                                known = False
            else:
                known = self.merges(self.tokens[a] + self.tokens[b])[0] == [self.tokens[a], self.tokens[b]]
            self.fits[key] = known
        return known

    def step(self, state: _State, byte: int) -> tuple[_State, tuple[int, ...]]:
        left, last, token, live = state.left, state.last, -1, []
        for j, tree in state.live:
            node = tree.get(byte)
            if node is None:
                continue
            t, below = node
            if token < 0 and t >= 0 and self.edge(t) is not None:
                before = last[j - 1] if j else left
                if before < 0 or self.neighbours(before, t):
                    token = t
            if below is not None:
                live.append((j, below))
        if token < 0:
            raise ValueError("the vocabulary lacks a single byte")
        text, last = state.pending + bytes((byte,)), (*last, token)
        live.append((len(text), self.root))
        cut = live[0][0]
        if cut == 0:
            return self.state(left, text, last, tuple(live)), ()
        for j, _ in live[1:]:  # the last boundary that lies on the way back from every live one
            while j != cut:
                if j > cut:
                    j -= self.size[last[j - 1]]
                else:
                    cut -= self.size[last[cut - 1]]
            if cut == 0:
                return self.state(left, text, last, tuple(live)), ()
        return self.state(last[cut - 1], text[cut:], last[cut:], tuple([(j - cut, tree) for j, tree in live])), tuple(self.between(last, cut))

    def between(self, last: tuple[int, ...], at: int) -> list[int]:
        out = []
        while at:
            out.append(last[at - 1])
            at -= self.size[out[-1]]
        return out[::-1]

    def follow(self, state: _State, rest: bytes) -> list[int]:
        """The same walk without making states, for bytes beyond those that the state table has room for."""
        left, last, live = state.left, list(state.last), state.live
        fits, root = self.fits.get, self.root
        n = len(last)
        for byte in rest:
            token, ahead = -1, []
            for j, tree in live:
                if byte in tree:
                    t, below = tree[byte]
                    if token < 0 <= t:
                        before = last[j - 1] if j else left
                        if before < 0:
                            known = self.edge(t) is not None
                        else:
                            known = fits(before << 32 | t)
                            if known is None:
                                known = self.edge(t) is not None and self.neighbours(before, t)
                        if known:
                            token = t
                    if below is not None:
                        ahead.append((j, below))
            if token < 0:
                raise ValueError("the vocabulary lacks a single byte")
            last.append(token)
            n += 1
            ahead.append((n, root))
            live = ahead
        return self.between(last, n)

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, out = self.start, []
        for i, byte in enumerate(piece):
            move = state.next.get(byte)
            if move is None:
                if len(self.states) >= self.most:
                    out.extend(self.follow(state, piece[i:]))
                    return out
                move = state.next[byte] = self.step(state, byte)
            state, tokens = move
            if tokens:
                out.extend(tokens)
        out.extend(self.between(state.last, len(state.last)))
        return out


def _utf8_table() -> np.ndarray:
    """Next state by state and byte. 0: between characters; 1-3: so many continuation bytes to come; 4-7: after E0, ED,
    F0, F4, whose next byte has a narrower range; 8: error."""
    t = np.full((9, 256), 8, np.int8)
    t[0, 0x00:0x80], t[0, 0xC2:0xE0], t[0, 0xE1:0xF0], t[0, 0xF1:0xF4] = 0, 1, 2, 3
    t[0, 0xE0], t[0, 0xED], t[0, 0xF0], t[0, 0xF4] = 4, 5, 6, 7
    t[1, 0x80:0xC0], t[2, 0x80:0xC0], t[3, 0x80:0xC0] = 0, 1, 2
    t[4, 0xA0:0xC0], t[5, 0x80:0xA0], t[6, 0x90:0xC0], t[7, 0x80:0x90] = 1, 1, 2, 2
    return t


UTF8 = _utf8_table()


class Decoder:
    """Ids to bytes and text, one id after another. Text leaves when a character is complete; a byte that no character
    can hold there ends the pending one as U+FFFD."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens
        self.moves: dict[tuple[int, int], int] = {}
        self.state, self.pending = 0, b""

    def feed(self, token: int) -> str:
        piece = self.tokens[token]
        key = (self.state, token)
        to = self.moves.get(key)
        if to is None:
            to = self.state
            for byte in piece:
                to = int(UTF8[to, byte])
            self.moves[key] = to
        if to == 0:
            text, self.pending, self.state = (self.pending + piece).decode("utf-8"), b"", 0
            return text
        self.pending += piece
        if to != 8:
            self.state = to
            return ""
        out, held, state = [], b"", 0  # an error inside: byte by byte
        for byte in self.pending:
            nxt = int(UTF8[state, byte])
            if nxt == 8 and held:
                out.append("�")
                held, nxt = b"", int(UTF8[0, byte])
            if nxt == 8:
                out.append("�")
                held, state = b"", 0
                continue
            held, state = held + bytes([byte]), nxt
            if state == 0:
                out.append(held.decode("utf-8"))
                held = b""
        self.pending, self.state = held, state
        return "".join(out)

    def end(self) -> str:
        rest = "�" if self.pending else ""
        self.state, self.pending = 0, b""
        return rest


class _Pieces(dict):
    """Piece to (decimal ids, packed ids), bounded."""

    def __init__(self, machine: Transducer):
        self.machine = machine

    def __missing__(self, piece: str):
        ids = self.machine.encode(piece.encode("utf-8"))
        value = (",".join(map(str, ids)), np.array(ids, np.int32).tobytes())
        if len(piece) <= 64:
            if len(self) >= _PIECES:
                self.clear()
            self[piece] = value
        return value


_machines: dict[bytes, tuple[_Pieces, dict[int, bytes], dict[int, int]]] = {}


def _machine(content: bytes):
    key = hashlib.sha1(content).digest()
    if key not in _machines:
        machine = Transducer(read_ranks(content))
        whole = {}
        for t, b in machine.tokens.items():
            state = 0
            for byte in b:
                state = int(UTF8[state, byte])
            whole[t] = state == 0
        _machines[key] = (_Pieces(machine), machine.tokens, whole)
    return _machines[key]


_STEP = 1 << 16  # pieces looked up at once
_WHOLE = 1 << 18  # characters of a text that is split at once; a longer one is split as it is read


def _encode(content: bytes, pattern: str, ids_out: bool, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, tokens, whole = _machine(content)
        split = regex.compile(pattern)
        at_once = not split.groups  # findall returns groups where the pattern has some
        complete = np.array([whole.get(i, False) for i in range(max(whole, default=-1) + 1)], bool)

        def decoded(ids: np.ndarray) -> Iterator[bytes]:
            """Bytes of the ids; runs of whole characters at once, the rest through the state machine."""
            broken, run = np.flatnonzero(~complete[ids]).tolist(), ids.tolist()
            stream, at = Decoder(tokens), 0
            for b in broken:
                if b < at:
                    continue
                yield b"".join(map(tokens.__getitem__, run[at:b]))
                at, text = b + 1, stream.feed(run[b])
                while stream.state and at < len(run):
                    text += stream.feed(run[at])
                    at += 1
                yield text.encode("utf-8")
            yield b"".join(map(tokens.__getitem__, run[at:])) + stream.end().encode("utf-8")

        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                rows = []
                for text in part.column(1):
                    text = text.as_py() or ""
                    count, dec, raw, sha, back = 0, [], [], hashlib.sha256(), hashlib.sha256()
                    found = iter(split.findall(text)) if at_once and len(text) <= _WHOLE else (m.group() for m in split.finditer(text))
                    while True:
                        some = [pieces[piece] for piece in islice(found, _STEP)]
                        if not some:
                            break
                        packed = b"".join([x[1] for x in some])
                        ids = np.frombuffer(packed, np.int32)
                        if digests:
                            sha.update(("," if count else "").encode() + ",".join([x[0] for x in some]).encode())
                            back.update(b"".join(decoded(ids)))
                        count += len(ids)
                        if ids_out:
                            raw.append(ids)
                    rows.append((count, sha.hexdigest(), back.hexdigest(), np.concatenate(raw) if raw else np.zeros(0, np.int32)))
                columns, names = [part.column(0), pa.array([r[0] for r in rows], pa.int64())], ["id", "n_tokens"]
                if digests:
                    columns += [pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())]
                    names += ["ids_sha256", "decoded_sha256"]
                if ids_out:
                    offsets = np.concatenate([[0], np.cumsum([r[0] for r in rows])]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([r[3] for r in rows]))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def vocabulary(spark: SparkSession, path: str) -> bytes:
    """The rank file (at most some MB), read by Spark when the path has a scheme and else from this machine."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()["content"])
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, vocabulary_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text",
           ids: bool = True, digests: bool = False) -> DataFrame:
    """``id_column, n_tokens`` and ``ids`` (array<int>) of every whole text; ``digests`` adds SHA-256 of the decimal ids
    joined by commas and of the bytes that the ids decode to.

    Every match of ``pattern`` is encoded by itself, without special tokens. Null and empty texts have no token. Rows are
    independent: repeated ids give repeated rows, null ids stay null, other columns are dropped. Texts of any length pass
    through in steps; only the ids of one text are held.
    """
    content = vocabulary(docs.sparkSession, vocabulary_path)
    source = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens long" + ", ids_sha256 string, decoded_sha256 string" * digests + ", ids array<int>" * ids
    return source.mapInArrow(_encode(content, pattern, ids, digests), schema).withColumnRenamed("id", id_column)


def _decode(content: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _machine(content)[1]
        for batch in batches:
            texts = []
            for ids in batch.column(1):
                stream, out = Decoder(tokens), []
                for t in ids.values.to_numpy(zero_copy_only=False).tolist() if ids.is_valid else ():
                    out.append(stream.feed(t))
                texts.append("".join([*out, stream.end()]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return run


def decode(tokens: DataFrame, vocabulary_path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """``id_column, text`` of arrays of ids; null arrays give an empty text, unknown ids fail the job."""
    content = vocabulary(tokens.sparkSession, vocabulary_path)
    source = tokens.select(tokens[id_column].alias("id"), tokens[ids_column].alias("ids"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(_decode(content), f"id {kind}, text string").withColumnRenamed("id", id_column)
