"""External programs over partitions or batches.

A child process gets the lines of one partition
(or one bounded batch) on stdin while its stdout is read back as rows; stdin is
fed from a thread so a full pipe cannot deadlock. The command is an argument
list (D8); a non-zero exit fails the task with the tail of stderr (D5), so Spark
retries it and finally fails the job. Nothing is written outside the task: a
program that writes files gets a task-private folder whose files come back as
rows and are then removed, so a retried task starts clean.
"""

from __future__ import annotations

import collections
import os
import queue
import re
import selectors
import shutil
import subprocess
import tempfile
import threading
import time
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import default_partitions, scratch_path
from .index import RANGE_ROWS, ordered

OUT_CHUNK_LINES = 8192
RANGE_LINES = RANGE_ROWS
STDERR_TAIL = 40


class ExternalCommandError(RuntimeError):
    pass


def _feed(proc: subprocess.Popen, chunks: Iterable[str], errors: list) -> None:
    try:
        for text in chunks:
            if text:
                proc.stdin.write(text.encode("utf-8"))
    except BrokenPipeError:
        pass  # the program stopped reading; its exit code decides
    except BaseException as exc:  # noqa: BLE001 - re-raised by the reader
        errors.append(exc)
    finally:
        try:
            proc.stdin.close()
        except OSError:
            pass


def _text(raw: bytes) -> str:
    """Tool output as text; bytes that aren't UTF-8 fail the task instead of being altered."""
    try:
        return raw.decode("utf-8").rstrip("\r\n")
    except UnicodeDecodeError as exc:
        raise ExternalCommandError(f"the command's output is not UTF-8 text: {raw[:80]!r}") from exc


def _drain(stream, tail: collections.deque) -> None:
    for raw in iter(stream.readline, b""):
        tail.append(raw.decode("utf-8", "replace").rstrip("\n"))
    stream.close()


def _output_lines(proc: subprocess.Popen, tail: collections.deque) -> Iterator[bytes]:
    """Lines of the standard output; the standard error goes to ``tail``. One thread reads both."""
    held = {proc.stdout: b"", proc.stderr: b""}
    with selectors.DefaultSelector() as ready:
        for pipe in held:
            ready.register(pipe, selectors.EVENT_READ)
        while ready.get_map():
            for pipe in [key.fileobj for key, _ in ready.select()]:
                raw = os.read(pipe.fileno(), 1 << 16)
                *lines, held[pipe] = (held[pipe] + raw).split(b"\n")
                if not raw:
                    lines, held[pipe] = ([held[pipe]] if held[pipe] else []), b""
                    ready.unregister(pipe)
                    pipe.close()
                if pipe is proc.stdout:
                    yield from lines
                else:
                    tail.extend(x.decode("utf-8", "replace") for x in lines)


def run_files(cmd: Sequence[str], cwd: str) -> Iterator[list[str]]:
    """Run ``cmd``, which gets no standard input; yield stdout lines in lists.

    As ``run_lines``, but no thread is started: a tool that is called for a few lines costs little more than itself.
    """
    proc = subprocess.Popen(list(cmd), stdin=subprocess.DEVNULL, stdout=subprocess.PIPE, stderr=subprocess.PIPE, cwd=cwd)
    tail: collections.deque = collections.deque(maxlen=STDERR_TAIL)
    try:
        buf: list[str] = []
        for raw in _output_lines(proc, tail):
            buf.append(_text(raw))
            if len(buf) >= OUT_CHUNK_LINES:
                yield buf
                buf = []
        rc = proc.wait()
        if rc != 0:
            raise ExternalCommandError(f"command {list(cmd)!r} exited with {rc}: " + " | ".join(tail))
        if buf:
            yield buf
    finally:  # also when the reader stops early or an error leaves the process running
        if proc.poll() is None:
            proc.kill()
            proc.wait()
        proc.stdout.close()
        proc.stderr.close()


def run_lines(cmd: Sequence[str], chunks: Iterable[str], cwd: str | None = None) -> Iterator[list[str]]:
    """Run ``cmd`` with ``chunks`` (newline-terminated text) on stdin; yield stdout lines in lists."""
    proc = subprocess.Popen(list(cmd), stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.PIPE, cwd=cwd)
    errors: list = []
    tail: collections.deque = collections.deque(maxlen=STDERR_TAIL)
    writer = threading.Thread(target=_feed, args=(proc, chunks, errors), daemon=True)
    reader = threading.Thread(target=_drain, args=(proc.stderr, tail), daemon=True)
    writer.start()
    reader.start()
    try:
        buf: list[str] = []
        for raw in proc.stdout:
            buf.append(_text(raw))
            if len(buf) >= OUT_CHUNK_LINES:
                yield buf
                buf = []
        proc.stdout.close()
        writer.join()
        rc = proc.wait()
        reader.join()
        if errors:
            raise errors[0]
        if rc != 0:
            raise ExternalCommandError(f"command {list(cmd)!r} exited with {rc}: " + " | ".join(tail))
        if buf:
            yield buf
    finally:  # also when the reader stops early or an error leaves the process running
        if proc.poll() is None:
            proc.kill()
            proc.wait()


def _text_chunks(batches: Iterable[pd.DataFrame], value: str) -> Iterator[str]:
    for pdf in batches:
        if len(pdf):
            yield "\n".join(pdf[value].astype(str).tolist()) + "\n"


def _task_part() -> int:
    from pyspark import TaskContext

    ctx = TaskContext.get()
    return ctx.partitionId() if ctx is not None else 0


def pipe_partitions(
    df: DataFrame,
    cmd: Sequence[str],
    order: Sequence[str] | None = None,
    value: str = "value",
    partitions: int | None = None,
) -> DataFrame:
    """Every partition's lines through one process (A40, A41): ``part int, line_no bigint, value``.

    With ``order`` the input is range-partitioned and sorted first, so
    ``(part, line_no)`` is the global output order (D2). Without ``partitions`` their number grows with the lines.
    """
    src = ordered(df, order, partitions) if order else df
    src = src.select(value)
    cmd = list(cmd)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = _task_part()
        n = 0
        for lines in run_lines(cmd, _text_chunks(batches, value)):
            yield pd.DataFrame({"part": part, "line_no": range(n, n + len(lines)), "value": lines})
            n += len(lines)

    return src.mapInPandas(run, "part int, line_no long, value string")


def pipe_exit_codes(df: DataFrame, cmd: Sequence[str], value: str = "value") -> DataFrame:
    """Feed each partition to ``cmd`` and keep only the exit code (A42): ``part, exit_code, n_lines``."""
    cmd = list(cmd)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = _task_part()
        counted = [0]

        def chunks():
            for pdf in batches:
                counted[0] += len(pdf)
                if len(pdf):
                    yield "\n".join(pdf[value].astype(str).tolist()) + "\n"

        proc = subprocess.Popen(cmd, stdin=subprocess.PIPE, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
        errors: list = []
        _feed(proc, chunks(), errors)
        rc = proc.wait()
        if errors:
            raise errors[0]
        yield pd.DataFrame({"part": [part], "exit_code": [rc], "n_lines": [counted[0]]})

    return df.select(value).mapInPandas(run, "part int, exit_code int, n_lines long")


def _collect_outputs(prefix: str) -> Iterator[tuple[str, int, list[str]]]:
    """The files ``prefix.<suffix>`` in chunks: suffix, number of the first line, lines."""
    folder, base = os.path.split(prefix)
    for name in sorted(n for n in os.listdir(folder) if n.startswith(f"{base}.")):
        suffix = name[len(base) + 1:]
        with open(os.path.join(folder, name), "rb") as fh:
            n, buf = 0, []
            for raw in fh:
                buf.append(_text(raw))
                if len(buf) >= OUT_CHUNK_LINES:
                    yield suffix, n, buf
                    n, buf = n + len(buf), []
            if buf:
                yield suffix, n, buf


def _stored_shares(df: DataFrame, order: Sequence[str], value: str, shares: int, ranges: int) -> list[list[str]] | None:
    """``df`` put in ``order`` in so many ``ranges`` and stored: the files of each share of them, in order.

    None if the shared folder can't be opened by tasks; nothing is written then.
    """
    from ..sources.bgzf import files_of, open_store

    path = scratch_path(df.sparkSession, "ranges")
    try:
        open_store(path)
    except (OSError, ValueError, NotImplementedError):
        return None
    ordered(df, order, ranges).select(F.col(value).alias("value")).write.parquet(path)
    numbered = sorted((int(m[1]), f) for f in files_of(path) if (m := re.match(r"part-(\d+)", os.path.basename(f))))
    ranges = max([ranges, *[i + 1 for i, _ in numbered[-1:]]])
    return [[f for i, f in numbered if i * shares // ranges == share] for share in range(shares)]


def _stored_chunks(files: Sequence[str]) -> Iterator[str]:
    from pyarrow import parquet

    from ..sources.bgzf import open_store

    for path in files:
        store, inner = open_store(path)
        with store.open_input_file(inner) as f:
            for batch in parquet.ParquetFile(f).iter_batches(OUT_CHUNK_LINES, columns=["value"]):
                if batch.num_rows:
                    yield "\n".join(map(str, batch.column(0).to_pylist())) + "\n"


def pipe_multi_output(
    df: DataFrame,
    cmd: Sequence[str],
    order: Sequence[str] | None = None,
    value: str = "value",
    partitions: int | None = None,
) -> DataFrame:
    """One process per partition that writes several files ``{out}.<suffix>``.

    ``{out}`` in ``cmd`` is replaced by a task-private prefix; every file the
    program writes there comes back as rows ``part, suffix, line_no, value``.
    With ``order`` no task sorts much more than ``RANGE_LINES`` lines: where a process gets more, its lines
    are stored in several ranges, and it is fed one after the other.
    """
    cmd, schema = list(cmd), "part int, suffix string, line_no long, value string"

    def through(part: int, chunks: Iterable[str]) -> Iterator[pd.DataFrame]:
        work = tempfile.mkdtemp(prefix=f"vf-part{part}-", dir=os.getcwd())
        try:
            prefix = os.path.join(work, str(part))
            argv = [a.replace("{out}", prefix) for a in cmd]
            for _ in run_lines(argv, chunks, cwd=work):
                pass  # stdout is not part of the result; the files are
            for suffix, n, lines in _collect_outputs(prefix):
                yield pd.DataFrame({"part": part, "suffix": suffix, "line_no": range(n, n + len(lines)), "value": lines})
        finally:
            shutil.rmtree(work, ignore_errors=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from through(_task_part(), _text_chunks(batches, value))

    if order:
        k = partitions or default_partitions(df.sparkSession)
        a_process = -(-df.count() // (k * RANGE_LINES))
        shares = _stored_shares(df, order, value, k, k * a_process) if a_process > 1 else None
        if shares:
            def run_shares(numbers: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for part in (int(i) for pdf in numbers for i in pdf["id"]):
                    yield from through(part, _stored_chunks(shares[part]))

            return df.sparkSession.range(0, k, 1, k).mapInPandas(run_shares, schema)
        df = ordered(df, order, k)
    return df.select(value).mapInPandas(run, schema)


def _by_batch(df: DataFrame, batch_col: str, pos_col: str, value: str, partitions: int | None) -> DataFrame:
    """Batches dealt to ``partitions`` tasks by their id, each task's batches in order.

    The number of tasks is the caller's (or the session's shuffle partitions), never the
    input's size in bytes: a batch of three lines may keep a tool busy for hours.
    """
    k = partitions or default_partitions(df.sparkSession)
    rows = df.select(F.col(batch_col).cast("bigint").alias("batch_id"), F.col(pos_col).alias("pos"), F.col(value).alias("value"))
    return rows.repartitionById(k, F.pmod("batch_id", F.lit(k)).cast("int")).sortWithinPartitions("batch_id", "pos").select(
        "batch_id", "value")


def _runs(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, list[str]]]:
    """Batch id and lines of each stretch of rows of one batch within a frame."""
    for f in frames:
        ids, values = f["batch_id"].to_numpy(), f["value"].astype(str).tolist()
        cuts = [0, *((ids[1:] != ids[:-1]).nonzero()[0] + 1).tolist(), len(ids)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo < hi:
                yield int(ids[lo]), values[lo:hi]


def _batches(frames: Iterator[pd.DataFrame], prefix: Sequence[str]) -> Iterator[tuple[int, Iterator[str]]]:
    """Batch id and its text in chunks; a batch's rows stand together and may span frames."""
    runs, held = _runs(frames), []

    def chunks(bid: int) -> Iterator[str]:
        if prefix:
            yield "\n".join(prefix) + "\n"
        while (run := held.pop() if held else next(runs, None)) is not None:
            if run[0] != bid:
                held.append(run)
                return
            yield "\n".join(run[1]) + "\n"

    while (run := held.pop() if held else next(runs, None)) is not None:
        held.append(run)
        text = chunks(run[0])
        yield run[0], text
        for _ in text:  # a tool may stop reading early
            pass


def _pooled(pieces: Iterable[tuple], names: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Output ``(*keys, number of the first line, lines)`` as frames of many lines, however few a batch has.

    ``names`` are those of the keys; a frame is handed on from ``OUT_CHUNK_LINES`` lines on.
    """
    cols: dict[str, list] = {c: [] for c in (*names, "line_no", "value")}
    for *keys, n, lines in pieces:
        for name, key in zip(names, keys):
            cols[name] += [key] * len(lines)
        cols["line_no"] += range(n, n + len(lines))
        cols["value"] += lines
        if len(cols["value"]) >= OUT_CHUNK_LINES:
            yield pd.DataFrame(cols)
            cols = {c: [] for c in cols}
    if cols["value"]:
        yield pd.DataFrame(cols)


def pipe_batches(
    df: DataFrame,
    cmd: Sequence[str],
    batch_col: str = "batch_id",
    pos_col: str = "pos_in_batch",
    value: str = "value",
    partitions: int | None = None,
    prefix: Sequence[str] = (),
) -> DataFrame:
    """One process call per batch (A44): ``batch_id, line_no, value``.

    Batches are streamed into their process, so their size isn't bounded by memory.
    ``prefix`` lines (a file's header) are given to every process without being shuffled.
    """
    cmd, prefix = list(cmd), list(prefix)

    def outputs(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for bid, text in _batches(frames, prefix):
            n = 0
            for lines in run_lines(cmd, text):
                yield bid, n, lines
                n += len(lines)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _pooled(outputs(frames), ["batch_id"])

    return _by_batch(df, batch_col, pos_col, value, partitions).mapInPandas(run, "batch_id long, line_no long, value string")


def pipe_batches_file(
    df: DataFrame,
    cmd: Sequence[str],
    batch_col: str = "batch_id",
    pos_col: str = "pos_in_batch",
    value: str = "value",
    partitions: int | None = None,
    prefix: Sequence[str] = (),
) -> DataFrame:
    """One process call per batch with files (A16, A44): ``batch_id, suffix, line_no, value``.

    ``{in}`` in ``cmd`` is a task-private file with the batch's lines, ``{out}`` a
    task-private prefix: each file ``{out}.<suffix>`` comes back under its suffix, standard
    output under the empty one. Both are removed when the batch is done.
    """
    cmd, prefix = list(cmd), list(prefix)

    def outputs(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for bid, text in _batches(frames, prefix):
            work = tempfile.mkdtemp(prefix=f"vf-batch{bid}-", dir=os.getcwd())
            try:
                source, out = os.path.join(work, "batch"), os.path.join(work, f"out{bid}")
                with open(source, "w", encoding="utf-8", newline="") as fh:
                    fh.writelines(text)
                argv = [a.replace("{in}", source).replace("{out}", out) for a in cmd]
                n = 0
                for lines in run_files(argv, cwd=work):
                    yield bid, "", n, lines
                    n += len(lines)
                for suffix, n, lines in _collect_outputs(out):
                    yield bid, suffix, n, lines
            finally:
                shutil.rmtree(work, ignore_errors=True)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _pooled(outputs(frames), ["batch_id", "suffix"])

    return _by_batch(df, batch_col, pos_col, value, partitions).mapInPandas(
        run, "batch_id long, suffix string, line_no long, value string")


SENTINEL = "#END-OF-BATCH"


class LivedProcess:
    """A tool that stays up for many batches: a line of its own, which the tool prints again, ends each batch."""

    def __init__(self, cmd: Sequence[str]):
        self.cmd = list(cmd)
        self.proc = subprocess.Popen(self.cmd, stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.PIPE)
        self.tail: collections.deque = collections.deque(maxlen=STDERR_TAIL)
        self.lines: queue.Queue = queue.Queue(maxsize=4 * OUT_CHUNK_LINES)
        self.closed = False
        self.errors = threading.Thread(target=_drain, args=(self.proc.stderr, self.tail), daemon=True)
        self.errors.start()
        threading.Thread(target=self._read, daemon=True).start()

    def _read(self) -> None:
        for raw in self.proc.stdout:
            self._put(raw)
        self._put(None)

    def _put(self, item) -> None:
        while not self.closed:
            try:
                return self.lines.put(item, timeout=0.2)
            except queue.Full:
                continue

    def _write(self, chunks: Iterable[str], end: str, failed: list) -> None:
        try:
            for text in chunks:
                self.proc.stdin.write(text.encode("utf-8"))
            self.proc.stdin.write(f"{end}\n".encode())
            self.proc.stdin.flush()
        except OSError:
            pass  # the tool is gone; the reader sees its end
        except BaseException as exc:  # noqa: BLE001 - re-raised by the reader
            failed.append(exc)
            self.proc.kill()

    def batch(self, chunks: Iterable[str], end: str, seconds: float | None) -> Iterator[list[str]]:
        """The output of one batch; an error if the tool ends, or says nothing more, before the batch's end."""
        failed: list = []
        writer = threading.Thread(target=self._write, args=(chunks, end, failed), daemon=True)
        writer.start()
        limit = None if seconds is None else time.monotonic() + seconds
        buf: list[str] = []
        while True:
            try:
                raw = self.lines.get(timeout=None if limit is None else max(0.0, limit - time.monotonic()))
            except queue.Empty:
                raise ExternalCommandError(f"command {self.cmd!r} took more than {seconds} s for a batch") from None
            if failed:
                raise failed[0]
            if raw is None:
                self.errors.join(5)
                raise ExternalCommandError(f"command {self.cmd!r} ended with {self.proc.wait()} within a batch: " + " | ".join(self.tail))
            line = _text(raw)
            if line == end:
                writer.join()
                yield buf
                return
            buf.append(line)
            if len(buf) >= OUT_CHUNK_LINES:
                yield buf
                buf = []

    def close(self, kill: bool = False) -> None:
        """Let the tool end; what it says after its last batch, or a bad exit code then, is an error."""
        if kill:
            self.closed = True
            self.proc.kill()
            self.proc.wait()
            return
        self.proc.stdin.close()
        rest = self.lines.get()
        self.closed = True
        code = self.proc.wait() if rest is None else None
        if rest is not None or code:
            self.proc.kill()
            raise ExternalCommandError(f"command {self.cmd!r} " + (f"printed {_text(rest)[:80]!r} after its last batch" if rest is not None else f"exited with {code}"))


def pipe_batches_lived(
    df: DataFrame,
    cmd: Sequence[str],
    batch_col: str = "batch_id",
    pos_col: str = "pos_in_batch",
    value: str = "value",
    partitions: int | None = None,
    prefix: Sequence[str] = (),
    seconds: float | None = None,
    tries: int = 2,
) -> DataFrame:
    """Batches through one long-lived process per task (A44): ``batch_id, line_no, value``.

    For tools whose start costs more than a batch. After each batch the tool gets a line
    ``#END-OF-BATCH <id>`` and must print it again, after the batch's output, without holding
    output back. ``prefix`` goes before every batch. A batch may take ``seconds``; if the tool hangs or ends
    within one, it is started anew and the batch repeated from a task-private copy, ``tries`` times in all.
    """
    cmd, prefix = list(cmd), list(prefix)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        proc = None
        try:
            for bid, text in _batches(frames, prefix):
                with tempfile.TemporaryDirectory(prefix=f"vf-lived{bid}-", dir=os.getcwd()) as work:
                    spool, result = os.path.join(work, "in"), os.path.join(work, "out")
                    with open(spool, "w", encoding="utf-8", newline="") as fh:
                        fh.writelines(text)
                    for left in range(max(tries, 1) - 1, -1, -1):
                        proc = proc or LivedProcess(cmd)
                        try:
                            with open(spool, encoding="utf-8", newline="") as src, open(result, "w", encoding="utf-8", newline="") as out:
                                for lines in proc.batch(iter(lambda: src.read(1 << 16), ""), f"{SENTINEL} {bid}", seconds):
                                    out.writelines(f"{x}\n" for x in lines)
                            break
                        except ExternalCommandError:
                            proc.close(kill=True)
                            proc = None
                            if not left:
                                raise
                    # whole batches only: a repeated one leaves nothing of its first try
                    with open(result, encoding="utf-8", newline="\n") as done:
                        n = 0
                        while lines := [x[:-1] for _, x in zip(range(OUT_CHUNK_LINES), done)]:
                            yield pd.DataFrame({"batch_id": bid, "line_no": range(n, n + len(lines)), "value": lines})
                            n += len(lines)
            if proc is not None:
                proc.close()
                proc = None
        finally:
            if proc is not None:
                proc.close(kill=True)

    return _by_batch(df, batch_col, pos_col, value, partitions).mapInPandas(run, "batch_id long, line_no long, value string")
