"""Run an external program once per input file, in parallel tasks.

The reference ships a program archive to every worker, copies each input
file locally, fills ``#_INPUTFILE_#`` / ``#_OUTPUTFILE_#`` in a command
template, runs it, and stores the output under the input's name.  Here each
file row goes to a ``mapInPandas`` task that runs ``subprocess.run`` with a
timeout; exit code, stdout and stderr come back as columns (the reference
ignored the exit code and dropped stderr -- ``fail_on_error`` restores a hard
failure).  Ship programs with ``SparkContext.addArchive``/``addFile`` and
refer to them through ``SparkFiles.get`` paths in the template.  Keep
``spark.speculation`` off: a speculative copy would run the program twice.
"""

from __future__ import annotations

import shlex
import subprocess

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.text import INPUT_PLACEHOLDER, OUTPUT_PLACEHOLDER

RESULT_SCHEMA = "file_name string, exit_code int, stdout string, stderr string, output string"


def pipe_files(files: DataFrame, command: str, timeout: float = 600.0,
               fail_on_error: bool = False, path_col: str = "path",
               content_col: str | None = "content") -> DataFrame:
    """(file_name, exit_code, stdout, stderr, output) per input file.

    With ``content_col`` (a ``binaryFile`` scan) the file bytes are streamed
    to the program's stdin and ``#_INPUTFILE_#`` becomes ``/dev/stdin``;
    otherwise the (shared-storage) path is passed as is.  ``#_OUTPUTFILE_#``
    becomes ``/dev/stdout``, so the program's output comes back in the row --
    no task-local scratch files.  ``output`` repeats stdout for callers that
    store it under the input's name (``write_outputs``).
    """
    cols = [path_col] + ([content_col] if content_col else [])
    src = files.select(*cols)

    def run(batches):
        for pdf in batches:
            out = []
            for _, row in pdf.iterrows():
                path = row[path_col]
                name = path.rsplit("/", 1)[-1]
                data = bytes(row[content_col]) if content_col else None
                target = "/dev/stdin" if content_col else path.removeprefix("file:")
                cmd = command.replace(INPUT_PLACEHOLDER, shlex.quote(target)) \
                    .replace(OUTPUT_PLACEHOLDER, "/dev/stdout")
                try:
                    p = subprocess.run(cmd, shell=True, input=data, capture_output=True, timeout=timeout)
                    code, so, se = p.returncode, p.stdout, p.stderr
                except subprocess.TimeoutExpired as ex:
                    code, so, se = -9, ex.stdout or b"", (ex.stderr or b"") + b"\ntimeout"
                if fail_on_error and code != 0:
                    raise RuntimeError(f"{name}: exit {code}: {se[-2000:]!r}")
                text = so.decode("utf-8", errors="replace")
                out.append((name, int(code), text, se.decode("utf-8", errors="replace"), text))
            yield pd.DataFrame(out, columns=["file_name", "exit_code", "stdout", "stderr", "output"])

    return src.mapInPandas(run, RESULT_SCHEMA)


def write_outputs(results: DataFrame, path: str) -> None:
    """Store each file's result (output, else stdout) under its input name."""
    body = F.coalesce(F.col("output"), F.col("stdout"))
    results.select("file_name", body.alias("value")).write.mode("overwrite") \
        .partitionBy("file_name").text(path)
