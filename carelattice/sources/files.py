"""Sources: message files, bundle files, CSV files and tables.

Files are split: a large one is read by as many tasks as it has blocks, and no file is ever one value (but by whole_files).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.functions.columns import not_blank, strip, strip_column

from .blocks import FILE, blocks, numbered_pieces, pieces, records_at, records_of_blocks, short_pieces, states_of, stitched


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row for each file: file_path, file_name, file_size, value. For small files: the text is one value."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_size").alias("file_size"), "value"
    )


def split_messages(files: DataFrame, content: str = "value") -> DataFrame:
    """files with one row for each HL7 message: raw_message and its position. Messages begin at a line `MSH|`."""
    text = F.regexp_replace(F.col(content), r"\r\n?", "\n")
    parts = F.transform(F.split(strip(text), r"\n(?=MSH\|)"), strip)
    return files.select("*", F.posexplode(F.filter(parts, lambda x: x != "")).alias("arrival_seq", "raw_message")).drop(content)


def hl7_files(spark: SparkSession, path: str) -> DataFrame:
    """file_path, file_name, file_size, arrival_seq, raw_message: lines of any end, read in blocks; messages begin at a line `MSH|`."""
    found = stitched(records_at(spark, path, lambda lines: pc.starts_with(lines, b"MSH|"), b"\n"), b"\n")
    return found.filter(not_blank(F.col("record"))).select(*FILE, "arrival_seq", strip_column(F.col("record")).alias("raw_message"))


def split_bundles(files: DataFrame, content: str = "value") -> DataFrame:
    """files with one row for each bundle: raw_bundle. A file holds one JSON object or an array of them."""
    text = strip(F.col(content))
    several = F.from_json(text, "array<string>")
    return files.select("*", F.posexplode(F.when(text.startswith("["), F.coalesce(several, F.array(text))).otherwise(F.array(text))).alias("arrival_seq", "raw_bundle")).drop(content)


#: What may stand around elements: white space, and the mark that some files begin with.
_BLANK = b"\xef\xbb\xbf \t\r\n"
_STRING = re.compile(rb'"[^"\\]*+(?:\\.[^"\\]*+)*+"', re.DOTALL)
_REST = re.compile(rb'[^"\\]*+(?:\\.[^"\\]*+)*+"', re.DOTALL)


def _outside(chunk: bytes, inside: bool) -> tuple[bytes, bool]:
    """What of a chunk stands outside of JSON strings, and whether it ends within one."""
    if inside:
        rest = _REST.match(chunk)
        if not rest:
            return b"", True
        chunk = chunk[rest.end() :]
    text = _STRING.sub(b"", chunk)
    at = text.find(b'"')
    return (text, False) if at < 0 else (text[:at], True)


def _depth(text: bytes) -> int:
    return text.count(b"{") + text.count(b"[") - text.count(b"]")


def _is_array(chunk: bytes) -> bool:
    return chunk.lstrip(_BLANK).startswith(b"[")


#: What each byte does to the depth, as a signed byte; 2: a quote.
_KINDS = bytes(1 if b in b"{[" else 255 if b in b"}]" else 2 if b == ord('"') else 0 for b in range(256))
#: Bytes of chunks that are searched at once.
_MANY = 1 << 18


def _many(chunks: Iterator[bytes]) -> Iterator[list[bytes]]:
    """Chunks in lists of bounded bytes."""
    out, size = [], 0
    for chunk in chunks:
        out.append(chunk)
        size += len(chunk) + 1
        if size >= _MANY:
            yield out
            out, size = [], 0
    if out:
        yield out


def _brackets(text: bytes, inside: bool) -> tuple[np.ndarray, np.ndarray, bool] | None:
    """Where brackets stand outside of strings, what they do to the depth, and whether the text ends in a string. None if a backslash stands outside of strings."""
    kinds = np.frombuffer(text.translate(_KINDS), np.int8)
    at = np.flatnonzero(kinds)
    kind = kinds[at]
    quote = kind == 2
    if slashes := b"\\" in text:
        slash = np.flatnonzero(np.frombuffer(text, np.uint8) == ord("\\"))
        new = np.diff(slash, prepend=-2) != 1
        first, last = slash[new], slash[np.append(new[1:], True)]
        escaped = np.zeros(len(text) + 1, bool)
        escaped[last[(last - first) % 2 == 0] + 1] = True
        quote &= ~escaped[at]
    within = (np.cumsum(quote) + inside) & 1
    if slashes and not ((np.searchsorted(at[quote], slash) + inside) & 1).all():
        return None
    outside = (within == 0) & (kind != 2)
    return at[outside], kind[outside], bool(within[-1]) if len(within) else inside


def _ends(text: bytes, inside: bool, depth: int, base: int) -> tuple[list[int], bool, bool, int]:
    """Where objects end in a text, up to a `}` that closes none; whether that is all of it; the string state and depth it ends in."""
    found = _brackets(text, inside)
    if found is None:
        return [], False, inside, depth
    at, kind, inside = found
    level = depth + np.cumsum(kind)
    closing = np.frombuffer(text, np.uint8)[at] == ord("}")
    ends, low = at[closing] + 1, level[closing]
    wrong = np.flatnonzero(low < base)
    stop = wrong[0] if len(wrong) else len(low)
    return ends[:stop][low[:stop] <= base].tolist(), not len(wrong), inside, int(level[-1]) if len(level) else depth


def _elements(chunks: Iterator[bytes], info: dict, separator: bytes = b"}") -> Iterator[tuple[bool, list[bytes]]]:
    """The elements of a file's array, or its objects. Chunks end before a separator, which begins with `}`, so blocks begin behind one.

    Many chunks are searched at once; what holds other elements than objects, or brackets that don't match, chunk by chunk.
    """
    inside, depth, array, at = info.get("inside") or False, info.get("depth") or 0, info.get("array"), info.get("at") or 0
    base, held = int(bool(array)), []
    begins = depth <= base and not inside

    def single(chunk: bytes, closed: bool = True) -> Iterator[tuple[bool, list[bytes]]]:
        nonlocal inside, depth, held, begins
        if begins and not held:
            loose, chunk = _loose(chunk, array)
            for x in loose:  # elements that are no objects
                yield True, [x]
            if not chunk and not closed:
                return
        text, inside = _outside(chunk, inside)
        depth += _depth(text) - (closed and not inside)
        held.append(chunk + b"}" * closed)
        if not inside and depth <= base:
            depth = base
            yield begins, held
            held, begins = [], True

    def start(text: bytes, after: int) -> int:
        """Where what comes after a place goes on or begins; -1 if more than a comma stands before an object."""
        if held or not begins:
            return after
        first = text.find(b"{", after)
        return first if first >= 0 and text[after:first].strip(_BLANK) in ((b"", b",") if array else (b"",)) else -1

    several, after = _many(chunks), separator[1:]
    lead = after if info["block"] else b""  # what the separator before has behind its bracket
    some = next(several, None)
    while some:
        ahead = next(several, None)
        at += sum(map(len, some)) + len(some) * len(separator)
        closed = ahead is not None or at != info["file_size"] + len(separator)  # only what ends a file may lack its bracket
        if array is None:
            array = _is_array(some[0])
            base = depth = int(array)
            if array:
                some[0] = some[0].lstrip(_BLANK)[1:]
        text, done = lead + separator.join(some) + b"}" * closed, 0
        cut = text.rfind(b"}") + 1
        text, rest, lead = text[:cut], text[cut:], after
        if ahead is None and at == info["file_size"]:
            rest = after  # the file ends with a separator
        if text:
            ends, matched, *state = _ends(text, inside, depth, base)
            for end in ends:
                if (first := start(text, done)) < 0:
                    break
                yield begins, [*held, text[first:end]]
                held, begins, done = [], True, end
            else:
                first = start(text, done) if matched and done < len(text) else -1
                if first >= 0:
                    held.append(text[first:])
                if first >= 0 or done == len(text):
                    (inside, depth), done = state, len(text)
            if done < len(text):
                if done:
                    inside, depth = False, base
                for chunk in text[done:-1].split(b"}"):
                    yield from single(chunk)
        if rest:
            yield from single(rest, closed=False)
        some = ahead
    if held:
        yield begins, held


def _loose(chunk: bytes, array: bool) -> tuple[list[bytes], bytes]:
    """What stands before an object, cut at commas; and the chunk from the object on (nothing if there is none)."""
    plain = _STRING.sub(lambda m: b"x" * len(m[0]), chunk)
    at = plain.find(b"{")
    at = len(chunk) if at < 0 else at
    if not array:
        before = chunk[:at].strip(_BLANK)
        return [before] if before else [], chunk[at:]
    closing = plain.rfind(b"]", 0, at)
    stop = closing if closing >= 0 and not plain[closing + 1 : at].strip(_BLANK) else at
    cuts = [i for i in range(stop) if plain[i : i + 1] == b","]
    found = [chunk[a:b].strip(_BLANK) for a, b in zip([0, *(c + 1 for c in cuts)], [*cuts, stop], strict=True)]
    return [x for x in found if x], chunk[at:]


def _bundle_sums(rows: DataFrame, separator: bytes) -> DataFrame:
    """For each block of a file with several: depth and string state at its end, for either string state at its start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for info, chunks in blocks(batches, "file"):
            ends, first, size = [[False, 0], [True, 0]], None, 0
            for some in _many(chunks):  # many chunks as one text
                whole = separator.join(some) + separator
                size += len(whole)
                first = some[0] if first is None else first
                for end in ends:
                    if found := _brackets(whole, end[0]):
                        end[0], end[1] = found[2], end[1] + int(found[1].sum())
                    else:
                        text, end[0] = _outside(whole, end[0])
                        end[1] += _depth(text) - text.count(b"}")
            yield pa.RecordBatch.from_pylist([{"file": info["file"], "block": info["block"], "size": size, "array": _is_array(first or b""), "inside0": ends[0][0], "depth0": ends[0][1], "inside1": ends[1][0], "depth1": ends[1][1]}])

    return rows.filter("length < file_size").mapInArrow(run, "file long, block long, size long, array boolean, inside0 boolean, depth0 long, inside1 boolean, depth1 long")


def _bundle_states(pdf: pd.DataFrame) -> pd.DataFrame:
    out, inside, depth, array, at = [], False, 0, bool(pdf["array"].iloc[0]), 0
    for r in pdf.itertuples(index=False):
        out.append((r.file, r.block, inside, depth, array, at))
        at += r.size
        inside, depth = (r.inside1, depth + r.depth1) if inside else (r.inside0, depth + r.depth0)
    return pd.DataFrame(out, columns=["file", "block", "inside", "depth", "array", "at"])


def fhir_files(spark: SparkSession, path: str) -> DataFrame:
    """file_path, file_name, file_size, arrival_seq, raw_bundle: a file's JSON object, or one row for each element of its array.

    Elements that are no JSON stay as they are; an unclosed one reaches to the end of its file.
    """
    separator = "},\n" if short_pieces(spark, path, "},\n") else "}"  # few pieces where objects stand on lines of their own
    chunks, files = numbered_pieces(spark, path, separator)
    mark = separator.encode()
    states = states_of(_bundle_sums(chunks, mark), _bundle_states, "inside boolean, depth long, array boolean, at long")
    found = stitched(records_of_blocks(chunks, partial(_elements, separator=mark), b"", states, files), b"")
    return found.filter(not_blank(F.col("record"))).select(*FILE, "arrival_seq", strip_column(F.col("record")).alias("raw_bundle"))


def _rows(lines: Iterator[bytes], info: dict) -> Iterator[tuple[bool, list[bytes]]]:
    """CSV records: lines up to one that ends outside of quotes; blank lines between records are none."""
    inside = begun = bool(info.get("odd"))
    held: list[bytes] = []
    for line in lines:
        if not held and not inside and not line.strip():
            continue
        held.append(line)
        inside ^= line.count(b'"') % 2 == 1
        if not inside:
            yield not begun, held
            held, begun = [], False
    if held:
        yield not begun, held


def _parities(pdf: pd.DataFrame) -> pd.DataFrame:
    before = pdf["quotes"].cumsum().shift(fill_value=0)
    return pd.DataFrame({"file_path": pdf["file_path"], "block": pdf["block"], "odd": before % 2 == 1})


#: Stands for a line end within a quoted value while its record is parsed.
_LINE = "\x1e"


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """file_path, file_name, file_size, arrival_seq (0: the header), record: RFC 4180 records, line ends within quotes as \\x1e.

    Whether a block begins within quotes follows from how many quotes came before it: an odd number.
    """
    lines = pieces(spark, path)
    text = F.col("value").cast("string")
    sums = lines.groupBy("file_path", "block").agg(F.sum(F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))).alias("quotes"))
    return stitched(records_of_blocks(lines, _rows, _LINE.encode(), states_of(sums, _parities, "odd boolean")), _LINE.encode())


def csv_rows(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Rows by header, all columns as strings, RFC 4180 quoting (line breaks within quotes too), with file_path, file_name and row_idx.

    Large files are split. columns: those of the files, if they are known; else the first file's header.
    """
    names = columns or spark.read.option("header", True).option("escape", '"').csv(path).columns
    schema = ", ".join(f"`{c}` string" for c in names)
    found = csv_records(spark, path).filter("arrival_seq > 0").withColumn("_row", F.from_csv("record", F.lit(schema), {"escape": '"'}))
    clash = [c for c in ("file_path", "file_name") if c not in names]
    return found.select(*clash, F.col("arrival_seq").alias("row_idx"), *(F.translate(F.col("_row")[c], _LINE, "\n").alias(c) for c in names))


def table_rows(spark: SparkSession, name: str, run_id: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """A table's rows, those of one run if run_id is set (blank: all)."""
    df = spark.table(name)
    if run_id:
        df = df.filter(F.col("pipeline_run_id") == run_id)
    return df.select(*columns) if columns else df
