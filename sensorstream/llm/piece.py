"""SentencePiece BPE encoding and decoding by a table of each prefix's last token.

The BPE encoding of a text has one last token for every prefix of the text, and two tokens may stand
side by side in an encoding exactly when the encoding of their two strings together is these two
tokens. So one pass of an automaton over the text suffices: of the vocabulary's matches that end at a
place, the last token is the one that the last token of the remaining prefix tolerates. Ids are read
backwards from the end. Work is linear in the text however long a run without spaces is.

Two cuts make the pass cheap and change nothing. Where no vocabulary entry spans two neighbouring
characters, no merge can cross, so the text falls into independent runs (here: words); runs met
before are looked up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sensorstream.llm.common import hand_back, pieces

SPACE_MARK = "▁"
#: Runs that a task remembers, the longest such run, and neighbours whose fit it remembers.
MEMO_ENTRIES, MEMO_LENGTH, MEMO_FITS = 300_000, 48, 300_000
#: Bytes of text from which ids go back to Spark.
OUT_BYTES = 1 << 20


class Runs(dict):
    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, run: str) -> tuple[int, ...]:
        ids = self.encode(run)
        if len(run) <= MEMO_LENGTH and len(self) < MEMO_ENTRIES:
            self[run] = ids
        return ids


class PieceModel:
    """Vocabulary of a SentencePiece BPE model with identity normalisation, and the two directions."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.surface: list[str | None] = [None] * n
        self.byte_id, self.byte_of, self.silent, self.unknown = {}, {}, set(), model.unk_id()
        self.id_of, self.score = {}, {}
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_of[i] = int(piece[3:-1], 16)
                self.byte_id[self.byte_of[i]] = i
            elif model.is_control(i):
                self.silent.add(i)
            elif model.is_unused(i):
                raise ValueError("models with unused pieces are not supported")
            elif not model.is_unknown(i):
                self.surface[i] = piece.replace(SPACE_MARK, " ")
                self.id_of[piece], self.score[piece] = i, model.get_score(i)
        for i in self.silent:
            self.surface[i] = ""
        self.surface[self.unknown] = " ⁇ "
        self.history: dict[int, list] = {}
        self.same = {p: p for p in self.id_of}
        self.piece_of = {i: p for p, i in self.id_of.items()}
        joined = {c for p in self.id_of if len(p) > 1 for c in p}
        for c in joined - set(self.id_of):
            self.piece_of[n + ord(c)] = c
        self.automaton = ahocorasick.Automaton()
        for i, piece in self.piece_of.items():
            if len(piece) == 1 or self._merges(i)[-1][1] == piece:
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}
        self.cut = self._cuts()
        self.n = n
        self.runs = Runs(self._run)

    def _cuts(self) -> re.Pattern:
        """The pattern of runs: characters that occur together in vocabulary entries belong to one group,
        and a run is a stretch of one group, with the space marks before it if no entry has a mark after
        another character."""
        lead: dict[str, str] = {}

        def find(c: str) -> str:
            while lead.setdefault(c, c) != c:
                lead[c] = c = lead[lead[c]]
            return c

        late = any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.id_of)
        for piece in self.id_of:
            inner = piece if late else piece.lstrip(SPACE_MARK)
            for c in inner[1:]:
                lead[find(c)] = find(inner[0])
        groups: dict[str, list[str]] = {}
        for c in sorted(lead):
            groups.setdefault(find(c), []).append(re.escape(c))
        many = ["".join(g) for g in groups.values() if len(g) > 1 or any(g[0][-1] * 2 in p for p in self.id_of)]
        marks = "" if late else f"{SPACE_MARK}*"
        joined = {c for p in self.id_of if len(p) > 1 for c in p.lstrip("" if late else SPACE_MARK)}
        single = "".join(re.escape(c) for c in sorted(joined) if all(re.escape(c) not in g for g in many))
        many += [single] * bool(single)
        return re.compile("|".join([*(f"{marks}[{g}]+" for g in many), f"{SPACE_MARK}+", "."]), re.S)

    def _merges(self, token: int) -> list[tuple[float, str, str]]:
        """The merges of a piece's own string in order: score, then the outermost right and left symbol.
        The first entry is the state before any merge."""
        if token not in self.history:
            parts = list(self.piece_of[token])
            steps = [(0.0, parts[-1], parts[0])]
            while len(parts) > 1:
                best, k = max(((self.score.get(parts[i] + parts[i + 1], -np.inf), -i) for i in range(len(parts) - 1)))
                if best == -np.inf:
                    break
                joined = parts[-k] + parts[1 - k]
                parts[-k : 2 - k] = [self.same[joined]]
                steps.append((best, parts[-1], parts[0]))
            self.history[token] = steps
        return self.history[token]

    def _fit(self, left: int, right: int) -> bool:
        """Whether the encoding of the two pieces' strings together is the two pieces: play both merge
        orders against each other; they fit unless a merge across their border comes first."""
        a, b = self._merges(left), self._merges(right)
        i = j = 0
        while True:
            across = self.score.get(a[i][1] + b[j][2], -np.inf)
            in_a = a[i + 1][0] if i + 1 < len(a) else -np.inf
            in_b = b[j + 1][0] if j + 1 < len(b) else -np.inf
            if in_a == in_b == across == -np.inf:
                return True
            if in_a >= across and in_a >= in_b:
                i += 1
            elif across >= in_b:
                return False
            else:
                j += 1

    def _run(self, run: str) -> tuple[int, ...]:
        if len(run) == 1:
            i = self.id_of.get(run)
            return (i,) if i is not None else self._bytes(run)
        n = len(run)
        last: list[int] = [-1] * (n + 1)
        size = [0] * (n + 1)
        fits, fit = self.fits, self._fit
        for end, (token, length) in self.automaton.iter(run):
            end += 1
            if last[end] < 0:
                begin = end - length
                if begin:
                    pair = last[begin] << 32 | token
                    ok = fits.get(pair)
                    if ok is None:
                        if len(fits) >= MEMO_FITS:
                            fits.clear()
                        ok = fits[pair] = fit(last[begin], token)
                    if not ok:
                        continue
                last[end], size[end] = token, length
        ids = []
        while n:
            token = last[n]
            ids.extend((token,) if token < self.n else reversed(self._bytes(chr(token - self.n))))
            n -= size[n]
        return tuple(reversed(ids))

    def _bytes(self, char: str) -> tuple[int, ...]:
        return tuple(self.byte_id[b] for b in char.encode()) if self.byte_id else (self.unknown,)

    def encode(self, text: str) -> list[int]:
        """Ids of a text; the empty text has none."""
        if not text:
            return []
        if len(self.runs) >= MEMO_ENTRIES:
            self.runs.clear()
        marked = SPACE_MARK + text.replace(" ", SPACE_MARK)
        return list(chain.from_iterable(map(self.runs.__getitem__, self.cut.findall(marked))))

    def forget(self) -> None:
        """Let go of what was remembered of texts; the model stays."""
        self.runs.clear()
        self.fits.clear()

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes that are no UTF-8 become U+FFFD each, control pieces nothing, and the
        space that encoding put before the text goes."""
        out: list[str] = []
        surface, pending, seen = self.surface, bytearray(), False
        for i in ids:
            s = surface[i]
            if s is None:
                pending.append(self.byte_of[i])
                continue
            if pending:
                out.append(_utf8(bytes(pending)))
                pending.clear()
                seen = True
            if not seen and s:
                seen = True
                if s[0] == " " and i != self.unknown:
                    s = s[1:]
            out.append(s)
        if pending:
            out.append(_utf8(bytes(pending)))
        return "".join(out)


def _utf8(data: bytes) -> str:
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, k = [], 0
        while k < len(data):
            for width in (1, 2, 3, 4):
                try:
                    out.append(data[k : k + width].decode())
                    k += width
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                k += 1
        return "".join(out)


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def encode_pieces(df: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Add `ids` (array of int) to every row: the ids of the whole `text`, without begin or end ids.
    With `decoded`, also add the text that these ids decode to.

    Null and empty texts have an empty array (and decode to the empty text). Other columns pass through
    unless they bear one of the new names; those are replaced. Rows are neither moved nor dropped, so an
    empty table gives an empty table and repeated rows stay. `model` is a path that every executor has."""
    names = [ids] + [decoded] * bool(decoded)
    keep = [f for f in df.schema.fields if f.name not in names]
    schema = T.StructType([*keep, T.StructField(ids, T.ArrayType(T.IntegerType(), True)), *(T.StructField(x, T.StringType()) for x in names[1:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = piece_model(model)
        for batch in batches:
            for part in pieces(batch, text, OUT_BYTES):
                found, sizes, texts = [], [0], []
                for value in part.column(text).to_pylist():
                    own = m.encode(value) if value else []
                    found.append(np.array(own, np.int32))
                    sizes.append(len(own))
                    if decoded:
                        texts.append(m.decode(own))
                flat = pa.array(np.concatenate(found) if found else np.zeros(0, np.int32))
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), flat)
                columns = [part.column(f.name) for f in keep] + [lists] + [pa.array(texts, pa.string())] * bool(decoded)
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        m.forget()
        hand_back()

    return df.mapInArrow(run, schema)


def decode_pieces(df: DataFrame, model: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Add `text`, decoded from the array column `ids`; null arrays give the empty text. Ids outside the
    vocabulary raise. A column already named `text` is replaced."""
    keep = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType([*keep, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = piece_model(model)
        for batch in batches:
            texts = pa.array([m.decode(x) if x else "" for x in batch.column(ids).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in keep), texts], names=schema.names)

    return df.mapInArrow(run, schema)

