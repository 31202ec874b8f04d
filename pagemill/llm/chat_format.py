"""Chat formatting at the level of tokens, with loss masks, and reading it back."""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import batched, read_table

# Control strings of the template; each stands for one reserved id after the vocabulary's own.
BEGIN, BODY, END = "<|turn|>", "<|body|>", "<|done|>"
RESERVED = (BEGIN, BODY, END)
# Strings that other templates give a meaning; they are defused inside texts as well.
FOREIGN = ("<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LEARNED_ROLE = "assistant"
# Fixed value: the pattern by which the vocabulary's encoder cuts text before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

BLANK_RUN = re.compile(r"\s{10000}")


class Escape:
    """Puts a backslash behind the first character of every control string, reversibly.

    A string that has backslashes there already gets one more, so taking one away restores the text.
    Control strings must neither hold nor overlap each other.
    """

    def __init__(self, controls: tuple[str, ...] = RESERVED + FOREIGN):
        for a, b in itertools.product(controls, repeat=2):
            overlap = any(a.endswith(b[:n]) for n in range(1, len(b)))
            if "\\" in a or (a != b and a in b) or overlap:
                raise ValueError(f"control strings {a!r} and {b!r} cannot be told apart")
        bodies = "|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in controls)
        self.found = re.compile(bodies)

    def escape(self, text: str) -> str:
        return self.found.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self.found.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


class Coder:
    """A byte-level encoder from a rank file, and the reserved ids behind it."""

    _made: dict[bytes, Coder] = {}

    def __init__(self, content: bytes):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        self.encoding = tiktoken.Encoding("chat", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        first = max(ranks.values()) + 1
        self.ids = {control: first + n for n, control in enumerate(RESERVED)}

    @classmethod
    def of(cls, content: bytes) -> Coder:
        key = hashlib.blake2b(content).digest()
        if key not in cls._made:
            cls._made.clear()
            cls._made[key] = cls(content)
        return cls._made[key]

    def encode(self, text: str) -> list[int]:
        """Tokens of the text. Very long blank runs, which the library cannot take, are cut."""
        ids, start = [], 0
        for blank in BLANK_RUN.finditer(text):
            ids += self.encoding.encode_ordinary(text[start : blank.end()])
            start = blank.end()
        return ids + self.encoding.encode_ordinary(text[start:])

    def decode(self, ids) -> str:
        return self.encoding.decode_bytes(ids).decode("utf-8", "replace")


SEGMENTS = pa.schema(
    [
        ("conv_id", pa.int64()), ("turn", pa.int64()), ("place", pa.binary()),
        ("ids", pa.list_(pa.int32())), ("mask", pa.list_(pa.int8())),
    ]
)


def format_turns(conversations: DataFrame, vocabulary_path: str) -> DataFrame:
    """(conv_id, turn, place, ids, mask) for each row of (conv_id, turn, role, text).

    `ids` are BEGIN, the role's tokens, BODY, the text's tokens, END; role and text are escaped and
    encoded apart, so no token spans a boundary and no text can make a reserved id. `mask` is 1 on
    the text and END of the assistant. `place` puts equal turns of a conversation into an order.
    Null role or text is empty. Rows stay in their own partitions. Other columns are ignored. The
    vocabulary file is read on the driver and broadcast; its size does not grow with the data.
    """
    with open(vocabulary_path, "rb") as file:
        content = conversations.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, escape = Coder.of(content.value), Escape()
        begin, body, end = (coder.ids[c] for c in RESERVED)

        def rows():
            for batch in batches:
                for some in (batch.slice(n, 512) for n in range(0, batch.num_rows, 512)):
                    conv, turn, role, text = (c.to_pylist() for c in some.columns)
                    flat: list[int] = []
                    starts, steps = [], []
                    for who, said in zip(role, text):
                        starts.append(len(flat))
                        flat.append(begin)
                        flat += coder.encode(escape.escape(who or ""))
                        flat.append(body)
                        if who == LEARNED_ROLE:
                            steps.append((len(flat), 1))
                        flat += coder.encode(escape.escape(said or ""))
                        flat.append(end)
                        if who == LEARNED_ROLE:
                            steps.append((len(flat), -1))
                    # The mask is the prefix sum of +1 where a learned span begins and -1 behind it.
                    change = np.zeros(len(flat) + 1, np.int8)
                    for at, step in steps:
                        change[at] += step
                    mask = np.cumsum(change[:-1], dtype=np.int8)
                    ids = np.array(flat, np.int32)
                    for n, (a, b) in enumerate(itertools.pairwise([*starts, len(flat)])):
                        place = hashlib.blake2b(f"{role[n]!r} {text[n]!r}".encode(), digest_size=8).digest()
                        yield conv[n], turn[n], place, ids[a:b], mask[a:b]

        yield from batched(rows(), SEGMENTS, lambda row: 64 + 5 * len(row[3]))

    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.col("role").cast("string"), F.col("text").cast("string"),
    )
    return rows.mapInArrow(run, "conv_id long, turn long, place binary, ids array<int>, mask array<tinyint>")


def assemble(segments: DataFrame) -> DataFrame:
    """The segments of a conversation together in one partition, in the order of its turns.

    Null turns come first. A conversation is never held as a whole: its rows are sorted with spilling
    and are read one by one, so its length is bounded by nothing.
    """
    return segments.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "place")


def read_back(assembled: DataFrame, vocabulary_path: str) -> DataFrame:
    """Per conversation, from the ids and masks of its sorted segments: turns, learned text, lengths.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_ids). Roles and texts
    are what stands between the reserved ids, unescaped; the learned text is what the mask marks. Rows
    with a null conv_id count as one conversation.
    """
    with open(vocabulary_path, "rb") as file:
        content = assembled.sparkSession.sparkContext.broadcast(file.read())
    schema = pa.schema(
        [
            ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
            ("n_ids", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, escape = Coder.of(content.value), Escape()
        begin, body, end = (coder.ids[c] for c in RESERVED)
        controls = sum(map(len, RESERVED))

        def segments():
            for batch in batches:
                conv, ids, mask = batch.column(0), batch.column(3), batch.column(4)
                for n in range(batch.num_rows):
                    yield (
                        conv[n].as_py(), ids[n].values.to_numpy(zero_copy_only=False),
                        mask[n].values.to_numpy(zero_copy_only=False),
                    )

        def rows():
            for conv_id, own in itertools.groupby(segments(), key=lambda s: s[0]):
                turns, learned = hashlib.sha256(), hashlib.sha256()
                n_turns = loss_chars = formatted = n_ids = 0
                for _, ids, mask in own:
                    if ids[0] != begin or ids[-1] != end:
                        raise ValueError("a segment does not begin and end with its reserved ids")
                    middle = int(np.flatnonzero(ids == body)[0])
                    role, text = coder.decode(ids[1:middle].tolist()), coder.decode(ids[middle + 1 : -1].tolist())
                    turns.update(f"{escape.unescape(role)}\n{escape.unescape(text)}\n".encode())
                    marked = ids[(mask == 1) & (ids < begin)]
                    if len(marked):
                        said = escape.unescape(coder.decode(marked.tolist()))
                        learned.update(said.encode())
                        loss_chars += len(said)
                    n_turns += 1
                    formatted += controls + len(role) + len(text)
                    n_ids += len(ids)
                yield conv_id, n_turns, turns.hexdigest(), loss_chars, learned.hexdigest(), formatted, n_ids

        yield from batched(rows(), schema, lambda row: 256)

    return assembled.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
        " formatted_chars long, n_ids long",
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, whose texts hold control strings, formatted and read back."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return read_back(assemble(format_turns(rows, path)), path).drop("n_ids")


# Formatting adds three control strings of eight characters to each turn, and one character for each
# control string in a role or text.
CONTROL_SQL = r"[<](\\*)(\|turn\|>|\|body\|>|\|done\|>|\|endoftext\|>|s>|/s>|<SYS>>|</SYS>>)|[\[](\\*)(/?INST\])"
OP9_SQL = rf"""
    WITH said AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
        CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(24 + length(role) + length(text) + len(regexp_extract_all(role, '{CONTROL_SQL}'))
            + len(regexp_extract_all(text, '{CONTROL_SQL}'))) AS BIGINT) AS formatted_chars
    FROM said GROUP BY conv_id"""
