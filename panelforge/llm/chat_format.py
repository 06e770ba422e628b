"""Conversations as token sequences with a loss mask, assembled token by token.

Every turn is encoded by itself and its marks are spliced in as reserved ids,
which follow the tokenizer's own vocabulary, so no text can ever produce one:

    user        [INST] text [/INST]
    system      [SYS] text [/SYS]
    assistant   <s> text </s>
    other role  [ROLE] role [/ROLE] text [/TURN]

The template adds no blanks. The places of a turn's segments are prefix sums
of their lengths, and the loss mask is the prefix sum of +1 at the first and
-1 after the last id of each assistant text.

Control strings that stand in a text - the marks and the tokenizer's own
special tokens - are escaped by a backslash after their first character
(``<\\s>``); one that already has backslashes there gets one more, so taking
one away again restores every text.

Encoding is map-only. The encoded turns are shuffled once, to their
conversation, sorted there and streamed: a task holds one Arrow batch and at
most ``PIECE_TOKENS`` ids of the conversation at hand. A longer conversation
continues in further rows (``piece`` 0, 1, ...; ``last`` marks the end). A
conversation's rows are in one task since its sequence, and the digests that
``read_back`` takes, have one order; the task's memory does not grow with it.

The tokenizer must be lossless (byte-level), so that decoding gives the text.

Defined cases: a null text is empty, a null role is the other role of the
empty name; rows of a null conversation form one conversation; turns are
ordered with null first, ties by role, then by token ids; repeated rows are
each a turn; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import pieces
from .tokens import Encoder

#: Reserved strings; their ids follow the tokenizer's vocabulary in this order.
MARKS = ("[INST]", "[/INST]", "[SYS]", "[/SYS]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[/TURN]")
#: Opening and closing mark of a role.
ROLES = {"user": (0, 1), "system": (2, 3), "assistant": (4, 5)}
_OTHER, _NAMED, _END = 6, 7, 8
#: The role whose texts are under the loss mask.
LEARNED = "assistant"
#: Ids of one row at most.
PIECE_TOKENS = 1 << 18
#: Ids decoded at a time.
DECODE_TOKENS = 1 << 18

_TURNS = "conv_id {}, turn {}, role string, ids binary, loss_from int, loss_to int"
_PIECES = "conv_id {}, piece int, last boolean, n_tokens int, input_ids array<int>, loss_mask array<tinyint>"
_DIGESTS = ("conv_id {}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
            "formatted_chars long")


def control_strings(tokenizer_path: str) -> tuple[str, ...]:
    """The marks and the tokenizer's special tokens."""
    lib = Encoder.get(tokenizer_path).lib
    return (*MARKS, *(t.content for t in lib.get_added_tokens_decoder().values() if t.content not in MARKS))


@cache
def _patterns(controls: tuple[str, ...]) -> list[tuple[str, str]]:
    """(first character, the rest of the control strings that begin with it)."""
    rest: dict[str, list[str]] = {}
    for c in controls:
        if len(c) < 2 or c[0] in c[1:] or c[0] == "\\":
            raise ValueError(f"control string {c!r} cannot be escaped after its first character")
        rest.setdefault(c[0], []).append(re.escape(c[1:]))
    return [(re.escape(a), "|".join(x)) for a, x in rest.items()]


def escape(texts: pa.Array, controls: tuple[str, ...]) -> pa.Array:
    """A backslash more after the first character of every control string."""
    for a, rest in _patterns(controls):
        texts = pc.replace_substring_regex(texts, rf"({a})(\\*(?:{rest}))", r"\1\\\2")
    return texts


def unescape(text: str, controls: tuple[str, ...]) -> str:
    """The text whose escaped form this is."""
    for a, rest in _patterns(controls):
        text = re.sub(rf"({a})\\(\\*(?:{rest}))", r"\1\2", text)
    return text


def _spliced(segments: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all turns, first id of every segment): the places are prefix sums of the lengths."""
    flat = [s for turn in segments for s in turn]
    return np.concatenate(flat) if flat else np.zeros(0, "<u4"), np.r_[0, np.cumsum([len(s) for s in flat])]


def encode_turns(conversations: DataFrame, tokenizer_path: str, *, conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn: its ids with marks, and where the loss begins and ends in them."""
    kinds = [conversations.schema[c].dataType.simpleString() for c in (conv_id, turn)]

    def work(batches):
        encoder = Encoder.get(tokenizer_path)
        base, controls = encoder.lib.get_vocab_size(), control_strings(tokenizer_path)
        mark = [np.array([base + i], "<u4") for i in range(len(MARKS))]
        for b in batches:
            roles = pc.fill_null(b.column("role").cast(pa.string()), "")
            body = encoder.ids(escape(pc.fill_null(b.column("text").cast(pa.large_string()), ""), controls))
            names = [r if r in ROLES else None for r in roles.to_pylist()]
            others = encoder.ids(escape(roles.filter(pa.array([n is None for n in names])), controls))
            cut, content = [], []
            for name, ids in zip(names, body):
                if name is None:
                    cut.append([mark[_OTHER], next(others), mark[_NAMED], ids, mark[_END]])
                else:
                    cut.append([mark[ROLES[name][0]], ids, mark[ROLES[name][1]]])
                content.append(len(cut[-1]) - 2)          # the text's segment
            ids, at = _spliced(cut)
            first = np.r_[0, np.cumsum([len(c) for c in cut])]            # segments before each turn
            begin, own = at[first], first[:-1] + np.array(content, np.int64)
            learned = np.array([n == LEARNED for n in names], bool)
            loss_from = np.where(learned, at[own] - begin[:-1], 0)
            loss_to = np.where(learned, at[own + 1] - begin[:-1], 0)
            cells = pa.Array.from_buffers(pa.large_binary(), len(cut), [
                None, pa.py_buffer((4 * begin).astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("turn"), roles, cells.cast(pa.binary()),
                 pa.array(loss_from.astype(np.int32)), pa.array(loss_to.astype(np.int32))],
                ["conv_id", "turn", "role", "ids", "loss_from", "loss_to"])

    return conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                                F.col(role).alias("role"), F.col(text).alias("text")).mapInArrow(
        work, _TURNS.format(*kinds))


def assemble(turns: DataFrame, piece_tokens: int = PIECE_TOKENS) -> DataFrame:
    """(conv_id, piece, last, n_tokens, input_ids, loss_mask): conversations in rows of at most piece_tokens ids."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def work(batches):
        held: list | None = None                          # conversation, piece, ids and masks not yet given out
        for b in batches:
            keys = b.column("conv_id").to_pylist()
            cells, size = _cells(b.column("ids"))
            at = np.r_[0, np.cumsum(size)]
            mask = np.zeros(at[-1] + 1, np.int8)
            np.add.at(mask, at[:-1] + b.column("loss_from").to_numpy(), 1)
            np.add.at(mask, at[:-1] + b.column("loss_to").to_numpy(), -1)
            mask = np.cumsum(mask[:-1], dtype=np.int8)
            out = []
            k = 0
            while k < len(keys):
                end = k + 1
                while end < len(keys) and keys[end] == keys[k]:
                    end += 1
                if held is not None and held[0] != keys[k]:
                    out += _pieces_of(held, True, piece_tokens)
                    held = None
                if held is None:
                    held = [keys[k], 0, [], []]
                held[2].append(cells[at[k]:at[end]])
                held[3].append(mask[at[k]:at[end]])
                out += _pieces_of(held, False, piece_tokens)
                k = end
            # what is held on must not hold the whole batch
            held = held and [*held[:2], [x.copy() for x in held[2]], [x.copy() for x in held[3]]]
            yield from _rows(out, b.schema.field("conv_id").type)
            key_type = b.schema.field("conv_id").type
        if held is not None:
            yield from _rows(_pieces_of(held, True, piece_tokens), key_type)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "ids")
    return ordered.mapInArrow(work, _PIECES.format(kind))


def _cells(column) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all cells, number of each cell's ids) of a binary column."""
    column = column.cast(pa.large_binary())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return np.frombuffer(raw.tobytes(), "<u4"), np.diff(offsets) // 4


def _pieces_of(held: list, whole: bool, limit: int) -> list[tuple]:
    """Full pieces of what is held; all of it, the last one marked, when the conversation has ended."""
    n = sum(map(len, held[2]))
    if not whole and n <= limit:
        return []
    ids, mask = np.concatenate(held[2]), np.concatenate(held[3])
    out, at = [], 0
    while n - at > limit:
        out.append((held[0], held[1], False, ids[at:at + limit], mask[at:at + limit]))
        held[1] += 1
        at += limit
    if whole:
        out.append((held[0], held[1], True, ids[at:], mask[at:]))
    else:
        held[2], held[3] = [ids[at:]], [mask[at:]]
    return out


def _rows(found: list[tuple], key_type):
    """Record batches of a bounded number of ids."""
    sizes = np.r_[0, np.cumsum([len(f[3]) for f in found])]
    for i, j in pieces(sizes, 4 * PIECE_TOKENS):
        part = found[i:j]
        at = pa.array((sizes[i:j + 1] - sizes[i]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in part], key_type), pa.array([f[1] for f in part], pa.int32()),
             pa.array([f[2] for f in part]), pa.array([len(f[3]) for f in part], pa.int32()),
             pa.ListArray.from_arrays(at, pa.array(np.concatenate([f[3] for f in part]).astype(np.int32))),
             pa.ListArray.from_arrays(at, pa.array(np.concatenate([f[4] for f in part])))],
            ["conv_id", "piece", "last", "n_tokens", "input_ids", "loss_mask"])


def format_conversations(conversations: DataFrame, tokenizer_path: str, *, piece_tokens: int = PIECE_TOKENS,
                         **columns) -> DataFrame:
    """The formatted conversations; ``columns`` names conv_id, turn, role and text where they differ."""
    return assemble(encode_turns(conversations, tokenizer_path, **columns), piece_tokens)


def _texts(lib, parts: list[np.ndarray]) -> list[str]:
    """Decoded segments, a bounded number of ids at a time."""
    out: list[str] = []
    sizes = np.r_[0, np.cumsum([len(p) for p in parts])]
    for i, j in pieces(sizes, DECODE_TOKENS):
        out += lib.decode_batch([p.tolist() for p in parts[i:j]], skip_special_tokens=False)
    return out


class _Reader:
    """What one conversation's ids say so far."""

    def __init__(self, key, controls):
        self.key, self.controls, self.n_turns, self.loss_chars, self.chars = key, controls, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.open, self.role = None, ""                   # opening mark of the turn at hand, its role

    def mark(self, m: int) -> None:
        self.chars += len(MARKS[m])
        opening = {a: r for r, (a, _) in ROLES.items()}
        if m in opening or m == _OTHER:
            self.open, self.role = m, opening.get(m, "")

    def segment(self, text: str, learned: str, closed_by: int) -> None:
        """The ids between two marks as text, and those of them under the loss mask."""
        self.chars += len(text)
        plain = unescape(text, self.controls)
        if learned:
            part = plain if learned == text else unescape(learned, self.controls)
            self.loss_chars += len(part)
            self.loss.update(part.encode())
        if closed_by == _NAMED:
            self.role = plain
            return
        self.n_turns += 1
        self.turns.update(f"{self.role}\n{plain}\n".encode())

    def row(self) -> tuple:
        return (self.key, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def read_back(formatted: DataFrame, tokenizer_path: str) -> DataFrame:
    """Number and digest of the turns, characters and digest of the texts under the mask, and formatted length.

    Everything is decoded from the ids and the mask. Conversations of one row
    are read where they lie; only those of several rows are brought together.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def work(batches):
        lib, controls = Encoder.get(tokenizer_path).lib, control_strings(tokenizer_path)
        base = lib.get_vocab_size()
        reader, rest = None, None                         # a conversation of several rows, and its unread ids
        for b in batches:
            done = []
            for key, last, ids, mask in zip(b.column("conv_id").to_pylist(), b.column("last").to_pylist(),
                                            _lists(b.column("input_ids")), _lists(b.column("loss_mask"))):
                if reader is None:
                    reader = _Reader(key, controls)
                if rest is not None:
                    ids, mask = np.concatenate([rest[0], ids]), np.concatenate([rest[1], mask])
                rest = _read(reader, lib, base, ids, mask)
                if last:
                    done.append(reader.row())
                    reader, rest = None, None
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[c] for d in done], t) for c, t in enumerate(
                    [b.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    one_row = F.col("last") & (F.col("piece") == 0)
    columns = ["conv_id", "piece", "last", "input_ids", "loss_mask"]
    several = formatted.where(~one_row).select(columns).repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    out = [x.mapInArrow(work, _DIGESTS.format(kind)) for x in (formatted.where(one_row).select(columns), several)]
    return out[0].unionAll(out[1])


def _lists(column):
    """Views of a list column's cells."""
    flat, at = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return (flat[a - at[0]:b - at[0]] for a, b in zip(at[:-1], at[1:]))


def _read(reader: _Reader, lib, base: int, ids: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Read all closed segments; the ids after the last mark are left for the next row."""
    marks = np.flatnonzero(ids >= base)
    if not len(marks):
        return ids.copy(), mask.copy()
    opening = {a for a, _ in ROLES.values()} | {_OTHER}
    spans, before = [], 0
    for m in marks:
        spans.append((before, int(m), int(ids[m]) - base))
        before = int(m) + 1
    parts = [ids[a:b] for a, b, m in spans if m not in opening]
    under = [mask[a:b] > 0 for a, b, m in spans if m not in opening]
    whole = _texts(lib, parts)
    learned = [t if u.all() else _texts(lib, [p[u]])[0] if u.any() else ""
               for t, p, u in zip(whole, parts, under)]
    at = 0
    for _, _, m in spans:
        if m not in opening:
            reader.segment(whole[at], learned[at], m)
            at += 1
        reader.mark(m)
    return ids[before:].copy(), mask[before:].copy()


def render(ids: np.ndarray, tokenizer_path: str) -> str:
    """The formatted text of a sequence of ids: decoded segments with the reserved strings between them."""
    lib = Encoder.get(tokenizer_path).lib
    base, ids = lib.get_vocab_size(), np.asarray(ids)
    marks = np.flatnonzero(ids >= base)
    parts = np.split(ids, np.sort(np.r_[marks, marks + 1]))
    return "".join(MARKS[int(p[0]) - base] if len(p) and p[0] >= base else t for p, t in zip(parts, _texts(lib, parts)))
