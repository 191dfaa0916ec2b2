"""Chat formatting: conversations rendered by a compiled template, with generation (loss) spans.

Rows are shuffled by conversation and sorted by turn; each task streams its conversations through the
template's closures turn by turn, so no conversation is gathered, however long. The output is one row a
piece (the opening, each turn, the closing): conv_id, part, text and the generation spans inside it.

The template marks turns with control strings. In roles and texts, a backslash is put after the first
character of every control string and every backslash is doubled, so no control string of the output comes
from a text, and dropping the backslash before any character gives the text back.

Defined results: null text or role is empty. Rows of one conversation with equal turns are ordered by role,
then text; null turns come first; repeated rows are kept. Rows with a null conv_id are one conversation
with a null id. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretrail.llm.common import table
from caretrail.llm.templates import compile_template

BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
CONTROLS = (BEGIN, END, OPEN, CLOSE)
TEMPLATE = """
{{- begin -}}
{% for m in messages -%}
  {{ open ~ (m.role | line) }}{{ "\\n" }}
  {%- if m.role == "assistant" %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}
  {{- close }}
{%- endfor %}
{{- end -}}
"""
PIECES = "conv_id bigint, part bigint, text string, spans array<struct<start:bigint,end:bigint>>"


def _escaper(controls: tuple[str, ...]) -> Callable[[str], str]:
    first = re.compile(r"\\|" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in controls))
    return lambda text: first.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text or "")


escape = _escaper(CONTROLS)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def line(text: str) -> str:
    """Escaped, with line breaks escaped too."""
    return escape(text).replace("\n", "\\\n")


def compiled(template: str = TEMPLATE) -> Callable:
    return compile_template(template, {"escape": escape, "line": line, "trim": lambda s: (s or "").strip(), "upper": lambda s: (s or "").upper()},
                            {"begin": BEGIN, "end": END, "open": OPEN, "close": CLOSE})


def _rows(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in it:
        yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))


def _runs(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(key, rows of that key) for neighbouring rows with one first column, lazily."""
    head = [next(rows, None)]

    def of(key: object) -> Iterator[tuple]:
        while head[0] is not None and head[0][0] == key:
            row, head[0] = head[0], None
            yield row
            head[0] = next(rows, None)

    while head[0] is not None:
        key = head[0][0]
        mine = of(key)
        yield key, mine
        for _ in mine:
            pass


def _formatter(template: str) -> Callable:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compiled(template)
        out: list = []
        schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()),
                            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
        for conv, turns in _runs(_rows(it)):
            part, size, texts, spans = 0, 0, [], []
            for piece in render({"role": r or "", "text": t or ""} for _, r, t in turns):
                if piece[0] is None:  # TURN
                    out.append({"conv_id": conv, "part": part, "text": "".join(texts), "spans": spans})
                    part, size, texts, spans = part + 1, 0, [], []
                    if len(out) >= 1000:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out = []
                    continue
                text, generated = piece
                if generated and text:
                    spans.append({"start": size, "end": size + len(text)})
                texts.append(text)
                size += len(text)
            out.append({"conv_id": conv, "part": part, "text": "".join(texts), "spans": spans})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    return run


def format_conversations(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """The formatted pieces, in order within each partition: conv_id, part, text, spans."""
    compiled(template)  # errors show here rather than in a task
    ordered = (rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                           F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text"))
    return ordered.mapInArrow(_formatter(template), PIECES)


def read_turns(pieces: Iterator[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn, read from formatted text that comes in pieces of any size."""
    buffer = ""
    for piece in pieces:
        buffer += piece
        while True:
            a, b = buffer.find(OPEN), buffer.find(CLOSE)
            if a < 0 or b < 0:
                break
            m = re.match(r"((?:[^\\\n]|\\.)*)\n(.*)\Z", buffer[a + len(OPEN):b], re.S)
            if m is None:
                raise ValueError("turn without a role line")
            yield unescape(m[1]), unescape(m[2])
            buffer = buffer[b + len(CLOSE):]


def _digests(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = []
    for conv, parts in _runs(_rows(it)):
        turns, loss, n, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

        def texts(parts: Iterator[tuple] = parts) -> Iterator[str]:
            nonlocal loss_chars, chars
            for _, _, text, spans in parts:
                chars += len(text)
                for s in spans:
                    said = unescape(text[s["start"]:s["end"]])
                    loss.update(said.encode())
                    loss_chars += len(said)
                yield text

        for role, text in read_turns(texts()):
            turns.update(f"{role}\n{text}\n".encode())
            n += 1
        out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
        if len(out) >= 2000:
            yield _digest_batch(out)
            out = []
    if out:
        yield _digest_batch(out)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


SAMPLE = f"{END}{OPEN} ok {CLOSE}"


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", SAMPLE), (-1, 1, "assistant", SAMPLE)], "conv_id bigint, turn bigint, role string, text string")
    return format_conversations(rows.unionByName(extra)).mapInArrow(
        _digests, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM generate_series(0, 1) t(i)),
l AS (SELECT *, length(role || text) + len(regexp_extract_all(role || chr(10) || text, '\\|</?s>|\[/?INST\]'))
                + len(regexp_extract_all(role, '\n')) + length('[INST]') + 1 + length('[/INST]') AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE role WHEN 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (length('<s>') + sum(n) + length('</s>'))::BIGINT AS formatted_chars
FROM l GROUP BY conv_id
"""
