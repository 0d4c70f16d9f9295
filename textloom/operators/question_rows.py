"""Task-side helpers of question windows: positions, spans and window shapes.

They work on one paragraph's arrays at a time; prefix sums of pieces per word
are built once per paragraph, so a question costs its own pieces only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# The separators of context words, as in functions.text.CONTEXT_SPACE.
_WORD = re.compile("[^ \t\r\n ]+")
_BREAK = re.compile("[ \t\r\n ]")
#: Windows gathered before they are passed on.
FLUSH_WINDOWS = 1000

#: What ``asked`` tells of a question.
_FIELDS = {
    "qa_no": "int", "qas_id": "string", "is_impossible": "boolean", "start_word": "int", "end_word": "int",
    "query_at": "int", "query_n": "int", "answer_at": "int", "answer_n": "int",
    "first": "int", "last": "int", "better_first": "int", "better_last": "int", "windows": "int",
}
ASKED = "array<struct<" + ",".join(f"{n}:{t}" for n, t in _FIELDS.items()) + ">>"
_ARROW = {"int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
ASKED_TYPE = pa.list_(pa.struct([(n, _ARROW[t]) for n, t in _FIELDS.items()]))


def first_occurrence(values: list, wanted: list) -> int:
    """Place of ``wanted`` in ``values``, or -1; linear by the prefix function."""
    if not wanted or len(wanted) > len(values):
        return -1
    border, k = [0] * len(wanted), 0
    for i in range(1, len(wanted)):
        while k and wanted[i] != wanted[k]:
            k = border[k - 1]
        k += wanted[i] == wanted[k]
        border[i] = k
    k = 0
    for i, v in enumerate(values):
        while k and v != wanted[k]:
            k = border[k - 1]
        k += v == wanted[k]
        if k == len(wanted):
            return i - k + 1
    return -1


def window_count(n: int, room: int, stride: int) -> int:
    """Windows needed to cover ``n`` pieces; the last one reaches the end."""
    if n <= room:
        return int(n > 0)
    return -(-(n - room) // min(room, stride)) + 1


def best_from(k: int, n: int, room: int, step: int, count: int) -> int:
    """First piece for which window ``k`` shows more context than window ``k - 1``.

    A window scores 100 * min(left, right) + length at a piece, and the lower
    window wins ties. Window starts and ends ascend and only the last window
    may be short, so the lead of a window over the one before it only grows
    along the pieces, and beating that neighbour means beating all. Window k
    therefore holds the best context for [best_from(k), best_from(k + 1)).
    """
    if k <= 0 or k >= count:
        return 0 if k <= 0 else n
    start, before = k * step, (k - 1) * step
    length = min(room, n - start)
    end, end_before = start + length - 1, before + room - 1
    # Where the rising side of k meets the falling side of k - 1.
    meet = (100 * (start + end_before) + room - length) // 200 + 1
    score = 100 * min(meet - start, end - meet) + length
    score_before = 100 * min(meet - before, end_before - meet) + room
    if meet <= end_before and score > score_before:
        return max(meet, start)
    return end_before + 1


def _words_until(context: str, at: int) -> list[str]:
    """The words that begin at character ``at`` or before, the last one whole; white space belongs to the word before it."""
    if at < 0:
        return []
    found = _BREAK.search(context, at)
    return _WORD.findall(context, 0, found.start() if found else len(context))


def asked_rows(cfg, training: bool, columns: list[str]):
    """Batches of encoded paragraphs to paragraphs with ``columns``, of which ``words`` and ``asked`` are made here.

    Rows hold ``context, qas, ids, piece_units`` and what else is passed on.
    Pieces of context words carry units from 0, question ``q`` unit -(2q+1) and
    its answer -(2q+2). With ``training``, questions whose answer can't be read
    back from the context words are left out.
    """

    def asked(qas, context, ids, units):
        n_context = int((units >= 0).sum())
        held, tail = units[:n_context], -units[n_context:]
        # Of the arrays' own type, or each search would copy them.
        before = lambda word: int(np.searchsorted(held, held.dtype.type(max(word, 0))))
        for q, qa in enumerate(qas or ()):
            own = np.array([2 * q + 1, 2 * q + 2, 2 * q + 3], dtype=tail.dtype)
            marks = (n_context + np.searchsorted(tail, own)).tolist()
            query_n = min(marks[1] - marks[0], cfg.max_query)
            row = {
                "qa_no": q, "qas_id": qa["id"], "is_impossible": False,
                "query_at": marks[0], "query_n": query_n, "answer_at": marks[1], "answer_n": marks[2] - marks[1],
                "windows": window_count(n_context, cfg.max_length - 3 - query_n, cfg.stride),
            }
            if training:
                row["is_impossible"] = bool(cfg.negatives and qa["is_impossible"])
                first_word = last_word = -1
                if not row["is_impossible"]:
                    if len(qa["answers"] or ()) != 1:
                        raise ValueError("each answerable question needs exactly one answer")
                    text, at = qa["answers"][0]["text"], qa["answers"][0]["answer_start"]
                    first_word = len(_WORD.findall(context, 0, at + 1)) - 1 if at >= 0 else -1
                    words = _words_until(context, at + len(text) - 1)
                    last_word = len(words) - 1
                    span = words[first_word:] if first_word >= 0 else _WORD.findall(context)[: last_word + 2]
                    if " ".join(text.split()) not in " ".join(span):
                        continue
                first, last = before(first_word), before(last_word + 1) - 1
                row |= {"start_word": first_word, "end_word": last_word, "first": first, "last": last}
                wanted = ids[marks[1] : marks[2]].tolist()
                hit = first_occurrence(ids[first : last + 1].tolist(), wanted)
                row["better_first"] = first if hit < 0 else first + hit
                row["better_last"] = last if hit < 0 else first + hit + len(wanted) - 1
            yield row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            cuts = column("ids").offsets.to_numpy()
            ids = column("ids").values.to_numpy(zero_copy_only=False)
            units = column("piece_units").values.to_numpy(zero_copy_only=False)
            contexts = [c or "" for c in column("context").to_pylist()]
            rows = zip(contexts, column("qas").to_pylist(), cuts, cuts[1:])
            made = {}
            if "asked" in columns:
                found = [list(asked(qas, context, ids[a:b], units[a:b])) for context, qas, a, b in rows]
                made["asked"] = pa.array(found, ASKED_TYPE)
            if "words" in columns:
                made["words"] = pa.array([_WORD.findall(c) for c in contexts], pa.list_(pa.string()))
            names = ["context_id", *columns]
            yield pa.RecordBatch.from_arrays([made[n] if n in made else column(n) for n in names], names)

    return run


class _Out:
    """Windows of a task until they are passed on."""

    def __init__(self, cfg, lists: list[str]):
        self.cfg, self.lists = cfg, lists
        self.clear()

    def clear(self) -> None:
        self.rows: list[tuple] = []
        self.sizes: list[int] = []
        self.tokens, self.units, self.words, self.ids = [], [], [], []

    def batch(self, names: list[str], kinds: list[pa.DataType], pieces: pa.Array | None, words: pa.Array | None) -> pa.RecordBatch:
        """``pieces`` and ``words`` are the texts that the gathered places point at."""
        width, n = self.cfg.max_length, len(self.rows)
        scalar = dict(zip(names, zip(*self.rows)))
        place = np.arange(width)
        inside = place < np.array(self.sizes, dtype=np.int64)[:, None]
        fixed = pa.array(np.arange(n + 1, dtype=np.int32) * width)
        square = lambda x: pa.ListArray.from_arrays(fixed, pa.array(x.astype(np.int32).ravel()))

        def input_ids() -> np.ndarray:
            ids = np.zeros((n, width), dtype=np.int32)
            ids[inside] = np.concatenate(self.ids)
            return ids

        ways = {
            "tokens": lambda: _lists(self.tokens, lambda at: pieces.take(pa.array(at))),
            "token_words": lambda: _lists(self.units, lambda v: pa.array(v.astype(np.int32))),
            "words": lambda: _lists(self.words, lambda at: words.take(pa.array(at))),
            "input_ids": lambda: square(input_ids()),
            "input_mask": lambda: square(inside),
            "segment_ids": lambda: square(inside & (place >= np.array(scalar["doc_offset"])[:, None])),
        }
        built = {name: ways[name]() for name in self.lists}
        scalars = [pa.array(scalar[c], k) for c, k in zip(names, kinds)]
        return pa.RecordBatch.from_arrays([*scalars, *built.values()], [*names, *built])


def _lists(parts: list[np.ndarray], values) -> pa.ListArray:
    cuts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), values(np.concatenate(parts)))


def cut_windows(
    cfg, cls_id: int, sep_id: int, cls: str, sep: str, numbered: bool, training: bool, names: list[str], kinds, lists: list[str]
):
    """Batches of paragraphs with ``asked`` to batches of windows.

    A paragraph's arrays are sliced where they lie; only windows are copied, and
    they are passed on a bounded number at a time. Of the arrays only those that
    ``lists`` names are made, and only the columns they come from are looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            cuts = column("piece_units").offsets.to_numpy()
            units = column("piece_units").values.to_numpy(zero_copy_only=False)
            texts = words = None
            if "words" in lists:
                word_cuts = column("words").offsets.to_numpy()
                words = column("words").values.cast(pa.large_string())
            if "input_ids" in lists:
                ids = column("ids").values.to_numpy(zero_copy_only=False)
                id_shift = int(column("ids").offsets[0].as_py()) - int(cuts[0])
            if "tokens" in lists:
                texts = pa.concat_arrays([column("pieces").values.cast(pa.large_string()), pa.array([cls, sep], pa.large_string())])
                cls_at, sep_at = len(texts) - 2, len(texts) - 1
                piece_shift = int(column("pieces").offsets[0].as_py()) - int(cuts[0])
            out = _Out(cfg, lists)
            asked = column("asked").to_pylist()
            firsts = [dict(f) for f in column("first_ids").to_pylist()] if numbered else [None] * len(asked)
            for k, context_id in enumerate(column("context_id").to_pylist()):
                low = int(cuts[k])
                here = units[low : cuts[k + 1]]
                n = int((here >= 0).sum())
                for qa in asked[k] or ():
                    room = cfg.max_length - 3 - qa["query_n"]
                    step, count = min(room, cfg.stride), qa["windows"]
                    ask = low + qa["query_at"] + np.arange(qa["query_n"])
                    if "tokens" in lists:
                        lead = np.concatenate([[cls_at], ask + piece_shift, [sep_at]])
                    if "input_ids" in lists:
                        lead_ids = np.concatenate([[cls_id], ids[ask + id_shift], [sep_id]])
                    shift = qa["query_n"] + 2
                    best = best_from(0, n, room, step, count)
                    for w in range(count):
                        first = w * step
                        length = min(room, n - first)
                        best_next = best_from(w + 1, n, room, step, count)
                        begin = low + first
                        of = here[first : first + length]
                        out.sizes.append(shift + length + 1)
                        if "tokens" in lists:
                            at = np.arange(begin + piece_shift, begin + piece_shift + length)
                            out.tokens.append(np.concatenate([lead, at, [sep_at]]))
                        if "input_ids" in lists:
                            out.ids.append(np.concatenate([lead_ids, ids[begin + id_shift : begin + id_shift + length], [sep_id]]))
                        if "token_words" in lists:
                            out.units.append(of)
                        if "words" in lists:
                            last = min(word_cuts[k] + int(of[-1]) + 1, word_cuts[k + 1])
                            out.words.append(np.arange(word_cuts[k] + of[0], last))
                        row = [qa["qas_id"], context_id, w, first, length, shift, best - first + shift, best_next - 1 - first + shift, int(of[0]), qa["is_impossible"]]
                        row.append(firsts[k][qa["qa_no"]] + w if numbered else qa["qa_no"])
                        if training:
                            inside = not qa["is_impossible"] and qa["better_first"] >= first and qa["better_last"] < first + length
                            row += [p - first + shift if inside else 0 for p in (qa["better_first"], qa["better_last"])]
                        out.rows.append(tuple(row))
                        best = best_next
                        if len(out.rows) >= FLUSH_WINDOWS:
                            yield out.batch(names, kinds, texts, words)
                            out.clear()
            if out.rows:
                yield out.batch(names, kinds, texts, words)

    return run
