"""What calls of the ingest have taken, beside the cleaned table.

A call is a folder ``call=<n>`` with the rows of its batches and, for each batch, the contract keys that
none of its records has, or may have: then with its files.  Its steps, each marked by a small file when it is done:

1. batches are listed, then taken; one that is repeated after a failure overwrites its own folder.  The list
   of a batch stays beside the calls until the batch is taken, so that a call that failed loses no file;
2. the contract is judged once, over all batches of all calls that wait.  Only where a key may be absent from
   all of them are their texts read again to be sure.  If it is broken nothing is
   stored; the call is closed and waits, to be judged again together with the next one;
3. ``fixed``: its rows that the table does not have are settled;
4. ``stored``: they are in the table.

A call that failed in its first step is gone on with by the next, later steps are repeated.  Stored calls stay until the models have been
extended by them, see :mod:`jobtide.plans.refresh`; without models they are dropped at once.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from jobtide.operators.lookup import keep_new, lookup_scope
from jobtide.plans.ingest import Layout, absent_of_all, check_contract, settled_absent
from jobtide.schema import CLEANED_COLUMNS, CLEANED_SCHEMA
from jobtide.sources.landing import dealt_lines, file_lines
from jobtide.sources.tables import (
    append_table,
    current_version,
    delete_path,
    list_names,
    read_table,
    read_text,
    rename_path,
    table_exists,
    write_text,
)

_TEXT = T.StructType([T.StructField("value", T.StringType())])


class Arrivals:
    """The calls beside the table, and the open one that batches go to.

    ``resume`` goes on with a call that failed; a call that reads the whole landing folder starts its own.
    """

    def __init__(self, spark: SparkSession, layout: Layout, resume: bool = True):
        self.spark, self.layout, self.root = spark, layout, layout.table("_arriving")
        self.lists = layout.table("_listed")
        calls = self._calls()
        last = calls[-1] if calls else 0
        self.failed = bool(calls) and not self._done(last, "closed") and not self._done(last, "stored")
        self.open = last if self.failed and resume and not self._done(last, "fixed") else last + 1

    def _calls(self) -> list[int]:
        return sorted(int(name.removeprefix("call=")) for name in list_names(self.spark, self.root))

    def _folder(self, call: int) -> str:
        return f"{self.root}/call={call:06d}"

    def _done(self, call: int, step: str) -> bool:
        return table_exists(self.spark, f"{self._folder(call)}/{step}")

    def _mark(self, call: int, step: str) -> None:
        write_text(self.spark, f"{self._folder(call)}/{step}", "")

    def hand_out(self, batch: int, files: Sequence[str]) -> None:
        """List the files of a batch, which is to be taken by this call or, if that fails, the next."""
        write_text(self.spark, f"{self.lists}/batch={batch}", json.dumps(list(files)))

    def handed_out(self) -> dict[int, list[str]]:
        """The batches that are not taken yet, with their files."""
        names = [name for name in list_names(self.spark, self.lists) if name.removeprefix("batch=").isdigit()]
        batches = sorted(int(name.removeprefix("batch=")) for name in names)
        return {batch: json.loads(read_text(self.spark, f"{self.lists}/batch={batch}")) for batch in batches}

    def took(self, batch: int, maybe_absent: int | None, files: Sequence[str]) -> None:
        """Note a batch of the list as taken."""
        self.note(batch, maybe_absent, files)
        delete_path(self.spark, f"{self.lists}/batch={batch}")

    def rows(self, batch: int | str) -> str:
        """An empty place for the rows of a batch of the open call."""
        path = f"{self._folder(self.open)}/rows/batch={batch}"
        delete_path(self.spark, path)
        return path

    def note(self, batch: int | str, absent: int | None, files: Sequence[str] = ()) -> None:
        """Keep what a batch tells about the contract; with ``files`` what it may lack, which they settle."""
        self._note(f"{self._folder(self.open)}/absent/batch={batch}", absent, files if absent else ())

    def _note(self, path: str, absent: int | None, files: Sequence[str] = ()) -> None:
        mask = "" if absent is None else str(absent)
        write_text(self.spark, path, "\n".join([mask, json.dumps(list(files))] if files else [mask]))

    def _notes(self, call: int) -> dict[str, tuple[int | None, list[str]]]:
        folder, notes = f"{self._folder(call)}/absent", {}
        for name in list_names(self.spark, folder):
            mask, _, files = read_text(self.spark, f"{folder}/{name}").partition("\n")
            notes[f"{folder}/{name}"] = (int(mask) if mask else None, json.loads(files) if files else [])
        return notes

    def _absent(self, calls: Sequence[int]) -> list[int | None]:
        """The keys that the batches of ``calls`` lack.

        While some key may be absent from all, the batches that leave it open are read again, in one job; what they
        lack together is noted for each.  Of files that are gone the records count as lacking what they may lack.
        """
        notes = {path: note for call in calls for path, note in self._notes(call).items()}
        unsure = {path: files for path, (_, files) in notes.items() if files}
        maybe = absent_of_all([mask for mask, _ in notes.values()])
        if unsure and maybe and self.layout.on_missing == "error":
            there = {path: [f for f in files if table_exists(self.spark, f)] for path, files in unsure.items()}
            whole = [path for path, files in unsure.items() if there[path] == files]
            if whole:
                files = [f for path in whole for f in there[path]]
                absent = settled_absent(self._text(files), maybe)
                for path in whole:
                    self._note(path, absent)
                    notes[path] = (absent, [])
        return [mask for mask, _ in notes.values()]

    def _text(self, files: Sequence[str]) -> DataFrame:
        lines = file_lines(self.spark, files, _TEXT, self.layout.landing, self.layout.multi_line)
        cores = self.spark.sparkContext.defaultParallelism
        return dealt_lines(lines, cores) if len(files) < cores else lines

    def store(self, keep_broken: bool = True) -> None:
        """Judge the calls that wait and append them one by one, so that a later one drops what an earlier has."""
        waiting = [call for call in self._calls() if not self._done(call, "stored")]
        try:
            check_contract(self.layout, self._absent(waiting))
        except ValueError:
            if not keep_broken:
                delete_path(self.spark, self._folder(self.open))
            elif self.open in waiting:
                self._mark(self.open, "closed")
            raise
        alone = waiting == [self.open] and not self.failed
        for call in waiting:
            self._append(call, alone)
            if current_version(self.spark, self.layout.table("conformed")) is None:
                self.drop(call)

    def _append(self, call: int, compared: bool) -> None:
        """``compared``: the rows have been compared with the table as it still is."""
        spark, layout, folder = self.spark, self.layout, self._folder(call)
        with lookup_scope():
            again = self._done(call, "fixed")
            if not again:
                if compared and list_names(spark, f"{folder}/rows"):
                    rename_path(spark, f"{folder}/rows", f"{folder}/new")
                elif not compared and (rows := self._read(f"{folder}/rows")) is not None:
                    new = keep_new(rows, read_table(spark, layout.cleaned, CLEANED_SCHEMA))
                    new.write.mode("overwrite").parquet(f"{folder}/new")
                self._mark(call, "fixed")
            if (new := self._read(f"{folder}/new")) is not None:
                if again:  # the append may have been done, too
                    new = keep_new(new, read_table(spark, layout.cleaned, CLEANED_SCHEMA))
                append_table(new, layout.cleaned, layout.partition_by, CLEANED_SCHEMA)
        self._mark(call, "stored")

    def _read(self, path: str) -> DataFrame | None:
        if not list_names(self.spark, path):
            return None
        reader = self.spark.read.schema(CLEANED_SCHEMA).option("recursiveFileLookup", True)
        return reader.parquet(path).select(*CLEANED_COLUMNS)

    def stored_after(self, upto: int) -> dict[int, DataFrame]:
        """The rows of the stored calls after ``upto`` that have any."""
        found = {call: self._read(f"{self._folder(call)}/new") for call in self._calls() if call > upto and self._done(call, "stored")}
        return {call: rows for call, rows in found.items() if rows is not None}

    def last_stored(self) -> int:
        return max((call for call in self._calls() if self._done(call, "stored")), default=0)

    def drop(self, upto: int) -> None:
        """Delete stored calls; of the last one the mark stays, so that numbers go on."""
        calls = self._calls()
        for call in calls:
            if call <= upto and self._done(call, "stored"):
                if call != calls[-1]:
                    delete_path(self.spark, self._folder(call))
                else:
                    for part in ("rows", "new", "absent", "fixed", "closed"):
                        delete_path(self.spark, f"{self._folder(call)}/{part}")
