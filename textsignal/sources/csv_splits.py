"""CSV files with quoted line breaks, read by as many tasks as any other text.

A split that begins in the middle of a file cannot know whether it begins inside a quoted field. So a first pass tells for
each split how it ends if it begins outside and if it begins inside; following these along each file gives every split its
true beginning. Then each split yields the records that lie in it, and the ends of records that cross splits are joined.
"""
import pyarrow as pa
from pyspark.sql import functions as F


def ends_quoted(line, quoted):
    """Whether the end of a line lies inside a quoted field, given its beginning. A quote opens a field only at its start; doubled quotes are text."""
    at = 0
    if not quoted and line.startswith('"'):
        quoted, at = True, 1
    while True:
        mark = line.find('"' if quoted else ',"', at)
        if mark < 0:
            return quoted
        if quoted and line.startswith('""', mark):
            at = mark + 2
        elif quoted:
            quoted, at = False, mark + 1
        else:
            quoted, at = True, mark + 2


def _runs(batches):
    """((path, start), lines) for each stretch of lines of one split, in the order of the file."""
    for batch in batches:
        paths, starts, lines = (batch.column(c).to_pylist() for c in ("path", "start", "value"))
        first = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or starts[i] != starts[first] or paths[i] != paths[first]:
                yield (paths[first], starts[first]), lines[first:i]
                first = i


def _read_splits(batches):
    """For each split: how it ends if it begins outside or inside a quoted field, and whether a record begins in it in the second case."""
    def row(key, state):
        return pa.RecordBatch.from_pydict({"path": [key[0]], "start": [key[1]], "outside": [state[0]], "inside": [state[1]], "begins": [state[2]]})
    current, state = None, None
    for key, lines in _runs(batches):
        if key != current:
            if current is not None:
                yield row(current, state)
            current, state = key, [False, True, False]
        for line in lines:
            state[2] = state[2] or not state[1]
            if '"' in line:
                state[0], state[1] = ends_quoted(line, state[0]), ends_quoted(line, state[1])
    if current is not None:
        yield row(current, state)


def _cut_records(inside, crossing):
    """Task function: whole records, or (`crossing`) the pieces of records that lie in several splits. `inside` names the split that owns
    the record in whose quoted field a split begins; all other splits begin with a record."""
    def work(batches):
        current, owner, open_lines, quoted, headed = None, None, [], False, True

        def rest():
            """The open lines: a piece if their record lies in other splits too, else a record. The first one of a file is its header."""
            nonlocal headed
            text = "\n".join(open_lines)
            if not open_lines or text.rstrip("\r") == "" and not quoted and owner == current[1]:
                return []
            is_header, headed = not headed, True
            return [(current[0], owner, current[1], text, is_header, quoted or owner != current[1])]

        for key, lines in _runs(batches):
            out = []
            if key != current:
                out += rest()
                current, open_lines, quoted = key, [], key in inside
                owner, headed = inside.get(key, key[1]), key[1] > 0
            for line in lines:
                if not quoted and open_lines:
                    out += rest()
                    owner, open_lines = current[1], []
                open_lines.append(line)
                if '"' in line:
                    quoted = ends_quoted(line, quoted)
            yield _table(out, crossing)
        yield _table(rest(), crossing)
    return work


def _table(rows, crossing):
    kept = [r for r in rows if r[5] == crossing]
    columns = list(zip(*kept)) or [[]] * 6
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["path", "owner", "start", "record", "header"])


def _openings(ends):
    """{(path, start): owner} of the splits that begin inside a quoted field, from the two possible ends of every split."""
    inside, path, quoted, owner = {}, None, False, None
    for e in sorted(ends, key=lambda e: (e["path"], e["start"])):
        if e["path"] != path:
            path, quoted = e["path"], False
        if quoted:
            inside[path, e["start"]] = owner
        if not quoted or e["begins"]:
            owner = e["start"]
        quoted = e["inside"] if quoted else e["outside"]
    return inside


def read_split_csv(spark, path, schema):
    """Comma-separated UTF-8 records, lines ended by \\n or \\r\\n, each file with a header; columns by position, as `schema` names them.

    Line breaks in quoted fields are kept as they are. Empty lines and files give no rows; a quote that is never closed takes
    the rest of its file, as in any reader. The driver holds a few numbers for each split of the files, as Spark's own list of splits does;
    a record of several splits is put together in one task. The text is read twice, a third time where records cross splits.
    """
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value"))
    ends = lines.mapInArrow(_read_splits, "path string, start long, outside boolean, inside boolean, begins boolean").toArrow().to_pylist()
    inside = _openings(ends)
    shape = "path string, owner long, start long, record string, header boolean"
    records = lines.mapInArrow(_cut_records(inside, False), shape).filter("NOT header").select("record")
    if inside:
        crossing = lines.mapInArrow(_cut_records(inside, True), shape)
        pieces = F.array_sort(F.collect_list(F.struct("start", "record")))
        joined = crossing.groupBy("path", "owner").agg(F.array_join(pieces["record"], "\n").alias("record"), F.max("header").alias("header"))
        records = records.unionByName(joined.filter("NOT header").select("record"))
    record = F.regexp_replace("record", r"\r\z", "")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parsed = F.from_csv(record, fields, {"escape": '"', "multiLine": "true"})
    return records.select(parsed.alias("_row")).select("_row.*")
