"""Chat formatting at token level.

Every turn becomes segments that are encoded on their own: a reserved id that opens the turn, the text, a reserved id that closes it. The
loss mask follows from prefix sums of segment lengths. Control strings inside a text get a backslash after their first character, so
they can neither be read as control strings nor be lost.

| role | form |
|---|---|
| user | ``[INST]text[/INST]`` |
| assistant | ``<s>text</s>`` |
| system | ``[SYS]text[/SYS]`` |
| any other | ``[ROLE]role[/ROLE]text[END]`` |
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from dayrisk.llm.common import narrowed, text_slices
from dayrisk.llm.packing import ByteTokenizer, tokenizer

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[END]")
FORMS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("[SYS]", "[/SYS]")}
#: The vocabulary has 50 257 ids with its one special token; reserved ids follow it.
FIRST_RESERVED = 50_257
RESERVED = {c: FIRST_RESERVED + i for i, c in enumerate(CONTROLS)}
_inside = re.compile("|".join(rf"(?<={re.escape(c[0])})\\*{re.escape(c[1:])}" for c in CONTROLS))
TURNS = "conv_id long, turn long, role string, text string, formatted string, ids binary, loss_from int, loss_to int"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long"


def escape(text: str) -> str:
    """Put a backslash after the first character of every control string, escaped ones included."""
    return _inside.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    """Undo ``escape``."""
    return _inside.sub(lambda m: m[0][1:] if m[0][0] == "\\" else m[0], text)


def format_turns(conversations: DataFrame, ranks_file: str | None = None) -> DataFrame:
    """One row per turn: its formatted text, its token ids (little-endian unsigned 32-bit) and the token span under the loss.

    Turns are formatted wherever they lie; a conversation is not gathered. Null text or role counts as empty, and an empty role is
    one of the others. An empty table gives an empty result.
    """
    file = ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, control = tokenizer(file).encode_all, {c: np.array([i], "<u4").tobytes() for c, i in RESERVED.items()}
        for batch in batches:
            for rows, texts in text_slices(batch):
                roles = [r or "" for r in rows.column("role").to_pylist()]
                bodies = [escape(t) for t in texts.to_pylist()]
                heads = [escape(r) for r in roles]
                coded = encode(pa.array(bodies + heads, pa.large_string()))
                formatted, ids, spans = [], [], []
                for k, role in enumerate(roles):
                    opening, closing = FORMS.get(role, ("[ROLE]", "[END]"))
                    segments = [(opening, control[opening], False)]
                    if role not in FORMS:
                        segments += [(heads[k], coded[len(roles) + k], False), ("[/ROLE]", control["[/ROLE]"], False)]
                    segments += [(bodies[k], coded[k], role == "assistant"), (closing, control[closing], False)]
                    ends = np.cumsum([len(s[1]) // 4 for s in segments])
                    at = next((j for j, s in enumerate(segments) if s[2]), 0)
                    spans.append((int(ends[at - 1]), int(ends[at])) if at else (0, 0))
                    formatted.append("".join(s[0] for s in segments))
                    ids.append(b"".join(s[1] for s in segments))
                made = [pa.array(roles, pa.string()), texts.cast(pa.string()), pa.array(formatted, pa.string()), pa.array(ids, pa.binary()), *(pa.array(s, pa.int32()) for s in zip(*spans))]
                yield pa.RecordBatch.from_arrays([rows.column("conv_id"), rows.column("turn"), *made], names=["conv_id", "turn", "role", "text", "formatted", "ids", "loss_from", "loss_to"])

    typed = narrowed(conversations, "conv_id", "turn", "role", "text").withColumns({c: F.col(c).cast("long") for c in ("conv_id", "turn")})
    return typed.mapInArrow(run, TURNS)


def read_turn(ids: np.ndarray, tokens: dict[int, bytes]) -> tuple[str, str]:
    """Role and text of a turn, from its ids alone."""
    text = lambda a, b: unescape(b"".join(tokens[i] for i in ids[a:b].tolist()).decode())
    opening = CONTROLS[ids[0] - FIRST_RESERVED]
    for role, (first, _) in FORMS.items():
        if opening == first:
            return role, text(1, -1)
    middle = int(np.flatnonzero(ids == RESERVED["[/ROLE]"])[0])
    return text(1, middle), text(middle + 1, -1)


_tokens: dict[str, dict[int, bytes]] = {}


def token_bytes(file: str) -> dict[int, bytes]:
    if file not in _tokens:
        own: ByteTokenizer = tokenizer(file)
        _tokens[file] = {rank: token for token, rank in own.encoding._mergeable_ranks.items()}
    return _tokens[file]


def conversation_digests(turns: DataFrame, ranks_file: str | None = None) -> DataFrame:
    """What the formatted turns say when they are read back, one row per conversation.

    Turns stream through in order of (turn, role, text), repeated turns included; only running digests are held, however long
    a conversation is. A null ``turn`` comes first; turns with a null ``conv_id`` are one conversation.
    """
    file = ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, at, state, done = token_bytes(file), None, None, []

        def close() -> None:
            done.append((at[0], state["n"], state["turns"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["formatted"], state["tokens"]))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done)) or [[]] * 7
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"])

        for batch in batches:
            for conv, chars, raw, a, b in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "chars", "ids", "loss_from", "loss_to"))):
                if at != (conv,):
                    if at:
                        close()
                    at, state = (conv,), {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "chars": 0, "formatted": 0, "tokens": 0}
                ids = np.frombuffer(raw, "<u4")
                role, text = read_turn(ids, tokens)
                state["turns"].update(f"{role}\n{text}\n".encode())
                lost = unescape(b"".join(tokens[i] for i in ids[a:b].tolist()).decode())
                state["loss"].update(lost.encode())
                state["n"] += 1
                state["chars"] += len(lost)
                state["formatted"] += chars
                state["tokens"] += len(ids)
            yield flush()
        if at:
            close()
            yield flush()

    told = turns.select("conv_id", "turn", "role", "text", F.length("formatted").alias("chars"), "ids", "loss_from", "loss_to")
    return told.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, DIGESTS)


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The conversations and conversation -1, whose texts are nothing but control strings and a word."""
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return narrowed(conversations, "conv_id", "turn", "role", "text").unionByName(probe)
