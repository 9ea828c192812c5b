"""Chat formatting of typed content parts.

A visitor walks a turn's parts (text, image, audio, document) in order and
flattens them: text is escaped, any other part becomes a numbered placeholder
whose attachment reference and expanded token count are recorded.  Turns are
formatted where they lie, before any shuffle; the template's marks start with
``<|`` and texts cannot contain that once escaped, so the output reads back
exactly.
"""

from __future__ import annotations

import hashlib
import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import as_text, id_type, parallelism

TURN, END = "<|turn|>", "<|end|>\n"
_HELD = re.compile(r"<\|(image|audio|document):(\d+)\|>")
_ESCAPED = re.compile(r"\\(.)", re.S)
TILE, TILE_TOKENS, BASE_TOKENS = 512, 170, 85      # of images
AUDIO_TOKENS_PER_S, PAGE_TOKENS = 25, 800          # of audio and documents


def escape(text: str) -> str:
    """Backslashes are doubled and ``<|`` is split by one, so a text holds no mark."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)


def _number(value, default: float) -> float:
    """A part's size; the default where it is no finite number above 0."""
    fine = isinstance(value, (int, float)) and not isinstance(value, bool) and math.isfinite(value) and value > 0
    return value if fine else default


class Flattener:
    """Visits the parts of one turn.

    Sizes that are missing, not numbers, not finite or not above 0 count as
    the least (an image of one tile, a document of one page, audio of no
    length); a text that is no string, a part of another type, and what is no
    part at all (a number, a string, null) become text as JSON writes them."""

    def __init__(self):
        self.out: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part) -> None:
        kind = part.get("type") if isinstance(part, dict) else None
        getattr(self, f"visit_{kind}" if kind in ("text", "image", "audio", "document") else "visit_unknown")(part)

    def visit_text(self, part: dict) -> None:
        text = part.get("text")
        if text is not None:
            self.out.append(escape(text if isinstance(text, str) else _json(text)))

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.out.append(f"<|{kind}:{len(self.attachments)}|>")
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "tokens": tokens})

    def visit_image(self, part: dict) -> None:
        w, h = (_number(part.get(x), TILE) for x in ("width", "height"))
        self._attach("image", part, BASE_TOKENS + TILE_TOKENS * math.ceil(w / TILE) * math.ceil(h / TILE))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil(_number(part.get("seconds"), 0) * AUDIO_TOKENS_PER_S))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, PAGE_TOKENS * math.ceil(_number(part.get("pages"), 1)))

    def visit_unknown(self, part) -> None:
        self.out.append(escape(_json(part)))


def _json(value) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True)


def listed_parts(raw: str) -> list:
    """A turn's parts from JSON: a list, or one part that stands alone; what
    is no JSON is a text."""
    try:
        found = json.loads(raw)
    except ValueError:
        return [{"type": "text", "text": raw}]
    return found if isinstance(found, list) else [found]


def format_turn(role: str, parts: list[dict]) -> tuple[str, int, int, list[dict]]:
    """The formatted turn, start and end of its body in it, attachments."""
    f = Flattener()
    for part in parts:
        f.visit(part)
    head, body = f"{TURN}{escape_role(role)}\n", "".join(f.out)
    return head + body + END, len(head), len(head) + len(body), f.attachments


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn; placeholders stay as they are."""
    role, body = formatted[len(TURN):len(formatted) - len(END)].split("\n", 1)
    return unescape_role(role), unescape(body)


def format_turns(turns: DataFrame, parts_col: str | None = None, loss_roles: tuple[str, ...] = ("assistant",),
                 id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """Per turn: id, turn, formatted, body_start, body_end (code points in
    ``formatted``), in_loss, attachments (JSON: kind, ref, tokens, in the
    order of their placeholders).

    ``parts_col`` holds a JSON list of parts (or one part; what is no JSON is a
    text); without it, or where it is NULL, the text is the one part.  Malformed
    parts are defined in ``Flattener``.  NULL roles and texts count as empty; repeated
    rows are turns of their own; other columns are ignored; an empty table
    stays empty.  No shuffle.
    """
    names = [id_col, turn_col, "formatted", "body_start", "body_end", "in_loss", "attachments"]

    def run(batches):
        for batch in batches:
            rows = []
            for role, text, parts in zip(*(c.to_pylist() for c in batch.columns[2:])):
                role = as_text(role)
                listed = listed_parts(parts) if parts is not None else [{"type": "text", "text": as_text(text)}]
                formatted, start, end, held = format_turn(role, listed)
                rows.append((formatted, start, end, role in loss_roles, json.dumps(held)))
            cols = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(list(c), k) for c, k in zip(cols, kinds))], names=names)

    empty = F.lit("")
    return turns.select(
        f"`{id_col}`", f"`{turn_col}`", F.coalesce(F.col(f"`{role_col}`"), empty).cast("binary").alias("_role"),
        F.coalesce(F.col(f"`{text_col}`"), empty).cast("binary").alias("_text"),
        (F.col(f"`{parts_col}`") if parts_col else F.lit(None).cast("string")).alias("_parts")).mapInArrow(
        run, f"`{id_col}` {id_type(turns, id_col)}, `{turn_col}` {id_type(turns, turn_col)}, formatted string,"
             " body_start bigint, body_end bigint, in_loss boolean, attachments string")


def digest_conversations(formatted: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Per conversation, read back from the formatted turns in order of turn
    (then of the turn's text): n_turns, digests and counts.

    SHA-256 of a whole conversation is sequential by nature, so a conversation
    is streamed through one task, one turn in memory at a time.
    """
    names = [id_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        key, state = None, None

        def ended():
            n, turns, loss, chars, total = state
            return (*key, n, turns.hexdigest(), chars, loss.hexdigest(), total)

        for batch in batches:
            done = []
            ids, _, *rest = (c.to_pylist() for c in batch.columns)
            for conv, formatted, start, end, in_loss in zip(ids, *rest):
                if key != (conv,):
                    if key is not None:
                        done.append(ended())
                    key, state = (conv,), [0, hashlib.sha256(), hashlib.sha256(), 0, 0]
                role, text = read_turn(formatted)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if in_loss:
                    masked = unescape(formatted[start:end])
                    state[2].update(masked.encode())
                    state[3] += len(masked)
                state[4] += len(formatted)
            if done:
                yield _rows(done, batch.schema.field(0).type)
            kind = batch.schema.field(0).type
        if key is not None:
            yield _rows([ended()], kind)

    def _rows(done, kind):
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*done), kinds)], names=names)

    n = parallelism(formatted.sparkSession)
    return formatted.select(f"`{id_col}`", f"`{turn_col}`", "formatted", "body_start", "body_end", "in_loss").repartition(
        n, f"`{id_col}`").sortWithinPartitions(f"`{id_col}`", f"`{turn_col}`", "formatted").mapInArrow(
        run, f"`{id_col}` {id_type(formatted, id_col)}, n_turns bigint, turns_sha256 string, loss_chars bigint,"
             " loss_sha256 string, formatted_chars bigint")
