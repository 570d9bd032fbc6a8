"""One file per key, written by tasks and put in place once all are written.

Each task writes into a folder of its own below ``_staging``.  Only when the whole job has
ended are files moved to their names, by tasks too, a folder each; an abort deletes the
folders.  So a task that is run again, or dies half way, leaves nothing that a reader could
take for a result.

Paths are URIs of any file system that Arrow knows, or local paths.
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from textloom.shipping import ship

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers that plan a source may lack this package

STAGING = "_staging"
#: Tasks for each core that write or read files.
TASKS = 4


def located(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    fs, at = arrow_fs.FileSystem.from_uri(path) if "://" in path else (arrow_fs.LocalFileSystem(), path)
    return fs, at.rstrip("/")


def safe_name(name: str) -> str:
    """A file name below the folder: no way up, no hidden or staging names."""
    parts = name.split("/")
    if not name or any(p in ("", ".", "..") or p[0] in "._" for p in parts):
        raise ValueError(f"not a file name: {name!r}")
    return name


@dataclass
class Staged(WriterCommitMessage):
    folder: str


class FileWriter(DataSourceArrowWriter):
    def __init__(self, path: str, job: str):
        self.path = path
        self.job = job

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        fs, root = located(self.path)
        folder = f"{root}/{STAGING}/{self.job}/{uuid.uuid4().hex}"
        fs.create_dir(folder, recursive=False)  # fails once the job's folder is gone
        names: set[str] = set()
        made: set[str] = {folder}
        try:
            for batch in iterator:
                for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist(), strict=True):
                    if safe_name(name) in names:
                        raise ValueError(f"two rows for the file {name}")
                    names.add(name)
                    at = f"{folder}/{name}"
                    _with_folder(fs, at, made)
                    with fs.open_output_stream(at) as out:
                        out.write((content or "").encode())
        except BaseException:
            if fs.get_file_info(folder).type == arrow_fs.FileType.Directory:
                fs.delete_dir(folder)
            raise
        return Staged(folder)

    def commit(self, messages: list[Staged | None]) -> None:
        """Puts down the folders of the tasks that count; ``move_staged`` moves their files."""
        fs, root = located(self.path)
        at = f"{root}/{STAGING}/{self.job}"
        with fs.open_output_stream(f"{at}/{FOLDERS}") as out:
            out.write(json.dumps([m.folder for m in messages if m]).encode())

    def abort(self, messages: list[Staged | None]) -> None:
        clear_staging(self.path, self.job)


#: In a job's staging folder, the folders of its tasks.
FOLDERS = "folders.json"


def _with_folder(fs: arrow_fs.FileSystem, at: str, made: set[str]) -> None:
    """Makes the folders of a file down from one of those made, which isn't made anew if it is gone."""
    folder = at.rpartition("/")[0]
    if folder not in made:
        _with_folder(fs, folder, made)
        fs.create_dir(folder, recursive=False)
        made.add(folder)


def move_staged(path: str, folder: str) -> int:
    """Moves a task's files to their names, and says how many; what an earlier try has moved is there already."""
    fs, root = located(path)
    made = {root}
    moved = 0
    for info in fs.get_file_info(arrow_fs.FileSelector(folder, recursive=True, allow_not_found=True)):
        if info.is_file:
            at = f"{root}/{info.path.removeprefix(folder).lstrip('/')}"
            _with_folder(fs, at, made)
            try:
                fs.move(info.path, at)
            except FileNotFoundError:  # another attempt of this task was faster
                continue
            moved += 1
    return moved


def clear_staging(path: str, job: str) -> None:
    """Deletes the job's folder, below which no task that still runs can make another."""
    fs, root = located(path)
    for at in (f"{root}/{STAGING}/{job}", f"{root}/{STAGING}"):
        for attempt in range(CLEARED):
            if fs.get_file_info(at).type != arrow_fs.FileType.Directory or not (at.endswith(job) or not fs.get_file_info(arrow_fs.FileSelector(at))):
                break
            try:
                fs.delete_dir(at)
            except OSError:  # a task has written meanwhile
                if attempt + 1 == CLEARED:
                    raise
                time.sleep(0.2)


#: Tries to delete a folder.
CLEARED = 10


class KeyedFiles(DataSource):
    """Sink of (name, content) rows, which stages files; options ``path`` and ``job``."""

    @classmethod
    def name(cls) -> str:
        return "keyed_files"

    def schema(self) -> str:
        return "name string, content string"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(self.options["path"], self.options["job"])


def write_files(df: DataFrame, path: str, name: Column, content: Column) -> None:
    """One file of UTF-8 per row; files of other names stay, those of equal names are replaced.

    Rows of one name meet in one task, which refuses the second; a null content is an empty
    file.
    """
    spark, job = df.sparkSession, uuid.uuid4().hex
    spark.dataSource.register(KeyedFiles)
    # a file costs the same however small it is, so tasks don't go by bytes
    rows = df.select(name.alias("name"), content.alias("content")).repartition(TASKS * spark.sparkContext.defaultParallelism, "name")
    fs, root = located(path)
    fs.create_dir(f"{root}/{STAGING}/{job}", recursive=True)
    rows.write.format("keyed_files").mode("append").option("path", path).option("job", job).save()

    def move(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"moved": [move_staged(path, folder) for folder in batch["folder"]]})

    with fs.open_input_stream(f"{root}/{STAGING}/{job}/{FOLDERS}") as f:
        folders = json.loads(f.read())  # one for each task
    if folders:
        ship(spark)
        of_tasks = spark.createDataFrame([(x,) for x in folders], "folder string").repartition(len(folders))
        of_tasks.mapInPandas(move, "moved long").agg(F.sum("moved")).collect()
    clear_staging(path, job)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``name`` below the folder, ``content``; Spark's readers pass over empty files."""
    whole = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    # Spark reads some 32 small files a task
    whole = whole.coalesce(TASKS * spark.sparkContext.defaultParallelism)
    root = "/" + path.split("://", 1)[-1].removeprefix("file:").strip("/") + "/"
    return whole.select(F.split_part("path", F.lit(root), F.lit(-1)).alias("name"), F.decode("content", "UTF-8").alias("content"))


def with_header(lines: list[Column], body: Column) -> Column:
    """Header lines, each after a hash, a blank line and the body; null lines are left out."""
    return F.concat_ws("\n", *(F.concat(F.lit("# "), x) for x in lines), F.lit(""), body)


def write_sections(sections: DataFrame, path: str, key: str, num: str, content: str, of_n: str, title: Column) -> None:
    """A file ``key_fNNN.txt`` for each section, its header saying which of how many it is.

    ``of_n`` counts the key's sections, blank ones too, which themselves have no file.
    """
    head = with_header([title, F.format_string("Fascicle %d of %d", F.col(num), F.col(of_n))], F.col(content))
    kept = sections.where(F.regexp_replace(content, r"(?U)\s+", "") != "")
    write_files(kept, path, F.format_string("%s_f%03d.txt", F.col(key).cast("string"), F.col(num)), head)


def write_chunks(chunks: DataFrame, path: str, key: str, no: str, text: str) -> None:
    """A file ``key/chunk_NNNN.txt`` for each chunk, numbered from 0."""
    write_files(chunks, path, F.format_string("%s/chunk_%04d.txt", F.col(key).cast("string"), F.col(no)), F.col(text))


def write_metadata(texts: DataFrame, path: str, key: str) -> None:
    """A file ``key_meta.json`` for each row, all its columns as an object, nulls too."""
    whole = F.to_json(F.struct(*texts.columns), {"ignoreNullFields": "false"})
    write_files(texts, path, F.concat(F.col(key).cast("string"), F.lit("_meta.json")), whole)


def write_translations(texts: DataFrame, path: str, key: str, title: Column, source: Column, credit: Column, body: str) -> None:
    """A file ``key_translation.md`` for each text: title, source and credit (if any), a rule, and the body."""
    head = F.concat(F.lit("# "), title, F.lit("\n"), source, F.lit("\n\n"), F.when(F.coalesce(credit, F.lit("")) != "", F.concat(credit, F.lit("\n\n"))).otherwise(""), F.lit("---\n\n"))
    write_files(texts, path, F.concat(F.col(key).cast("string"), F.lit("_translation.md")), F.concat(head, F.col(body)))


def write_glossary(entries: DataFrame, path: str, category: str, english: str, line: str, categories: tuple[str, ...]) -> None:
    """A file ``NN_category.md`` for each listed category that has entries: its name, its
    count, and its lines by English term.  Entries of other categories are left out."""
    lines = F.array_sort(F.collect_list(F.struct(F.lower(english).alias("k"), F.col(english).alias("e"), F.col(line).alias("l"))))
    rank = F.array_position(F.array(*map(F.lit, categories)), F.col(category))
    pages = entries.where(F.col(category).isin(*categories)).groupBy(category).agg(F.count("*").alias("n"), F.array_join(F.transform(lines, lambda x: x["l"]), "\n\n").alias("body"))
    name = F.format_string("%02d_%s.md", rank, F.col(category))
    write_files(pages, path, name, F.concat(F.lit("# "), F.col(category), F.format_string(" (%d)\n\n", "n"), F.col("body"), F.lit("\n")))
