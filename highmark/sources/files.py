"""Exactly named files, written and removed by the executors that hold the rows."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T


def _open(base: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(base)


def write_files(rows: DataFrame, base: str) -> None:
    """One UTF-8 file per row (``path`` below ``base``, ``text``).

    A file appears by rename, so a lost and repeated task only writes it again.
    """

    def write(part: Iterator[Row]) -> None:
        import posixpath
        import uuid

        store, root = _open(base)
        made = set()
        for row in part:
            target = posixpath.join(root, row.path)
            folder = posixpath.dirname(target)
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            hidden = posixpath.join(folder, f".{uuid.uuid4().hex}")
            with store.open_output_stream(hidden) as out:
                out.write(row.text.encode("utf-8"))
            store.move(hidden, target)

    _dealt(rows.select("path", "text")).foreachPartition(write)


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows over all cores: adaptive execution sizes tasks by bytes, and a file costs its opening."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, "path")


def read_files(rows: DataFrame, base: str) -> DataFrame:
    """``rows`` with ``found`` and the ``text`` of the file at ``path`` below ``base``.

    The executors open the files by their names, so no list of them is ever held anywhere. The text is
    in the UTF encoding that JSON documents are told by, and NULL where it cannot be decoded. A NULL path, or
    one that leads out of its folder, names no file; a file without a byte is none yet, as for Spark's readers.
    """

    def read(batches: Iterator) -> Iterator:
        import json
        import posixpath

        import pyarrow as pa

        store, root = _open(base)

        def text(path: str | None) -> tuple[bool, str | None]:
            if path is None or ".." in path.split("/"):
                return False, None
            try:
                with store.open_input_stream(posixpath.join(root, path)) as found:
                    data = found.read()
            except FileNotFoundError:
                return False, None
            if not data:
                return False, None
            try:
                return True, data.decode(json.detect_encoding(data))
            except UnicodeDecodeError:
                return True, None

        for batch in batches:
            paths, at, size, told = batch.column("path").to_pylist(), 0, 0, []
            for path in paths:
                told.append(text(path))
                size += len(told[-1][1] or "")
                if size > 1 << 22 or at + len(told) == len(paths):
                    part = batch.slice(at, len(told))
                    found, texts = zip(*told)
                    columns = [*part.columns, pa.array(found, pa.bool_()), pa.array(texts, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "found", "text"])
                    at, size, told = at + len(told), 0, []

    schema = T.StructType([*rows.schema.fields, T.StructField("found", T.BooleanType()), T.StructField("text", T.StringType())])
    return _dealt(rows).mapInArrow(read, schema)


def read_arrays(rows: DataFrame, base: str) -> DataFrame:
    """``rows`` once for each piece of the JSON array in the file at ``path`` below ``base``, the piece as ``text``.

    A piece is an array of some of the elements, in order, so that the array is never held whole. All of them can be
    parsed if and only if the file's first value can; ``text`` is NULL where no array or object can follow. As for
    Spark's reader a lone object counts as an array of one, a blank file has nothing, and what comes after is ignored.
    """

    def read(batches: Iterator) -> Iterator:
        import posixpath

        import pyarrow as pa

        for batch in batches:
            store, root = _open(base)
            for at, path in enumerate(batch.column("path").to_pylist()):
                with store.open_input_stream(posixpath.join(root, path)) as found:
                    for text in _pieces(found):
                        columns = [*batch.slice(at, 1).columns, pa.array([text], pa.string())]
                        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "text"])

    schema = T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())])
    return _dealt(rows).mapInArrow(read, schema)


def _pieces(stream, size: int = 1 << 20) -> Iterator[str | None]:
    """Pieces of the first JSON value in a stream of bytes, see ``read_arrays``; a single element is held whole."""
    import codecs
    import json
    import re

    # a text in quotes of either kind, as Spark allows both, a bracket, a comma; a quote alone opens a text that goes on
    token = re.compile(r"""["](?:[^"\\]++|\\.)*+["]|'(?:[^'\\]++|\\.)*+'|[][{},"']""", re.S)
    # elements without inner braces, each with its comma
    plain = re.compile(r"""(?:[ \t\r\n]*+\{(?:[^{}"']++|["](?:[^"\\]++|\\.)*+["])*+\}[ \t\r\n]*+,)++""", re.S)
    data = stream.read(size)
    decoder = codecs.getincrementaldecoder(json.detect_encoding(data))()
    held, root, depth, any_cut = "", "", 0, False
    at = cut = comma = 0  # how far it was looked at, where the next piece begins, where the last element to go ended
    while True:
        try:
            held += decoder.decode(data, final=not data)
        except UnicodeDecodeError:
            yield None
            return
        if not root:
            held = held.lstrip(" \t\r\n")
            root = held[:1]
            if root == "[":
                depth, at, cut, comma = 1, 1, 1, 1
            elif root not in ("{", ""):
                yield None
                return
        while at < len(held):
            if root == "[" and depth == 1 and at == comma and (run := plain.match(held, at)):
                at = comma = run.end()
                continue
            found = token.search(held, at)
            at = len(held) if found is None else found.end()
            mark = found and found.group()
            if mark in ('"', "'"):
                at = found.start()
                break
            if mark in ("[", "{"):
                depth += 1
            elif mark in ("]", "}"):
                depth -= 1
                if not depth:
                    if root == "{":
                        yield held[:at]
                    elif any_cut or mark == "}" or held[cut : at - 1].strip(" \t\r\n"):
                        yield f"[{held[cut:at]}" if held[cut : at - 1].strip(" \t\r\n") else None
                    return
            elif mark == "," and root == "[" and depth == 1:
                comma = at
        if comma > cut:
            piece = held[cut : comma - 1]
            yield f"[{piece}]" if piece.strip(" \t\r\n") else None
            cut, any_cut = comma, True
        if not data:
            if root:
                yield None
            return
        held, at, comma, cut = held[cut:], at - cut, comma - cut, 0
        # more at once the longer an element is, as a text that goes on is looked at from its start
        data = stream.read(max(size, len(held)))


def write_document(lines: DataFrame, target: str, empty: str) -> None:
    """One file out of sorted ``text`` rows, ``empty`` if there are none.

    Spark writes the parts beside the target; the driver's store client then streams them, in
    order and a few bytes at a time, into one hidden file that takes the target's place.
    """
    import posixpath
    import shutil
    import uuid

    folder, name = posixpath.split(target)
    beside = f"{folder}/.{uuid.uuid4().hex}"
    lines.select("text").write.text(beside)
    store, root = _open(folder)
    parts = sorted(f.path for f in store.get_file_info(_inside(posixpath.join(root, posixpath.basename(beside)))) if posixpath.basename(f.path).startswith("part-") and f.size)
    hidden = posixpath.join(root, f".{uuid.uuid4().hex}")
    with store.open_output_stream(hidden) as out:
        if not parts:
            out.write(empty.encode("utf-8"))
        for part in parts:
            with store.open_input_stream(part) as lines_of:
                shutil.copyfileobj(lines_of, out, 1 << 20)
    store.move(hidden, posixpath.join(root, name))
    store.delete_dir(posixpath.join(root, posixpath.basename(beside)))


def _inside(folder: str):
    from pyarrow import fs

    return fs.FileSelector(folder)


def delete_files(delta: DataFrame, base: str) -> None:
    """Remove the paths whose action is ``delete``; one that is already gone is no error."""

    def remove(part: Iterator[Row]) -> None:
        import posixpath

        from pyarrow import fs

        store, root = _open(base)
        for row in part:
            target = posixpath.join(root, row.path)
            if store.get_file_info(target).type != fs.FileType.NotFound:
                store.delete_file(target)

    delta.filter("action = 'delete'").select("path").foreachPartition(remove)


def read_small(base: str, name: str) -> str | None:
    """The text of a small file, ``None`` if there is none."""
    import posixpath

    from pyarrow import fs

    store, root = _open(base)
    target = posixpath.join(root, name)
    if store.get_file_info(target).type == fs.FileType.NotFound:
        return None
    with store.open_input_stream(target) as text:
        return text.read().decode("utf-8")


def replace_small(base: str, name: str, text: str) -> None:
    """A small file put in the place of its former self by a rename, so readers see one or the other."""
    import posixpath
    import uuid

    store, root = _open(base)
    store.create_dir(root, recursive=True)
    hidden = posixpath.join(root, f".{uuid.uuid4().hex}")
    with store.open_output_stream(hidden) as out:
        out.write(text.encode("utf-8"))
    store.move(hidden, posixpath.join(root, name))
