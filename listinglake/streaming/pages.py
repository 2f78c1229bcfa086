"""Pages of paged boards as they arrive, in any order.

The batch rule (:func:`listinglake.operators.requests.page_prefix`): a run uses its pages 1, 2, 3
and so on up to the first that does not lead on, of which it keeps the copies that were read. A
page leads on if any copy of it was read, holds entries and has a next link.

As pages arrive, leading pages only become more, so the stop of a run only moves up, and a copy
that counts once counts for good. State per run is the page awaited next and what waits behind
it: copies of later pages and which of those lead on. A copy at or before the awaited page is
given out at once and costs no state.

A batch costs a run a handful of calls to its state, however many copies it brings: one value
holds the awaited page, the first page that waits and the leading pages as spans of neighbours;
the copies that wait are appended as one chunk, read again only when their turn has come. Copies
that were not read never count and are left out before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PAGES = "request_seq bigint, run string, page bigint, ok boolean, entries bigint, has_next boolean"
USED = "request_seq bigint, run string, page bigint"


#: First and last of neighbouring pages, ascending; a gap parts two spans.
Spans = list[tuple[int, int]]


def _with_pages(spans: Spans, pages: set[int]) -> Spans:
    """``spans`` and ``pages`` together as spans of neighbouring pages."""
    joined: Spans = []
    for first, last in sorted([*spans, *((page, page) for page in pages)]):
        if joined and first <= joined[-1][1] + 1:
            joined[-1] = (joined[-1][0], max(joined[-1][1], last))
        else:
            joined.append((first, last))
    return joined


class _Run(StatefulProcessor):
    """The state of one run."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.progress = handle.getValueState(
            "progress", "awaited bigint, waits_from bigint, firsts array<bigint>, lasts array<bigint>"
        )
        self.waiting = handle.getListState("waiting", "pages array<bigint>, requests array<bigint>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = self.progress.get() or (1, None, [], [])
        start, waits_from = before[0], before[1]
        spans = list(zip(before[2], before[3], strict=True))
        copies: list[tuple[int, int]] = []
        fresh: set[int] = set()
        for row in rows:
            copies.append((row.page, row.request_seq))
            if row.leads and row.page >= start:
                fresh.add(row.page)
        # A span that reaches back to the awaited page moves it behind its end.
        awaited, spans = start, _with_pages(spans, fresh)
        if spans and spans[0][0] <= awaited:
            awaited = spans.pop(0)[1] + 1
        used = [one for one in copies if one[0] <= awaited]
        late = [one for one in copies if one[0] > awaited]
        if waits_from is not None and waits_from <= awaited:
            chunks = (zip(pages, requests, strict=True) for pages, requests in self.waiting.get())
            # A copy that landed twice while it waited counts once.
            held = dict.fromkeys(one for chunk in chunks for one in chunk)
            used += [one for one in held if one[0] <= awaited]
            late += [one for one in held if one[0] > awaited]
            self.waiting.clear()
            waits_from = None
        if late:
            pages, requests = map(list, zip(*late, strict=True))
            self.waiting.appendValue((pages, requests))
            waits_from = min(pages) if waits_from is None else min(waits_from, *pages)
        after = (awaited, waits_from, [first for first, _ in spans], [last for _, last in spans])
        if after != (start, before[1], list(before[2]), list(before[3])):
            self.progress.update(after)
        for page, request in used:
            yield Row(request_seq=request, run=key[0], page=page)

    def close(self) -> None:
        pass


def used_pages(pages: DataFrame) -> DataFrame:
    """The pages of a stream of ``PAGES`` that their runs use, each once; ``request_seq`` is unique.

    The run is the key of the state; its store must be the one of ``STATE_STORE``.
    """
    whole = pages.where("run IS NOT NULL AND request_seq IS NOT NULL AND ok AND page >= 1")
    leads = F.coalesce((F.col("entries") > 0) & F.col("has_next"), F.lit(False))
    return (
        whole.select("request_seq", "run", "page", leads.alias("leads"))
        .groupBy("run")
        .transformWithState(statefulProcessor=_Run(), outputStructType=USED, outputMode="Append", timeMode="None")
    )


def land_used_pages(
    spark: SparkSession, folder: str, target: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Append the pages that runs use, from landed Parquet of ``PAGES``, and stop when all is read.

    The checkpoint keeps the files read and the state of the runs: a later call goes on there.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    landed = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return (
        used_pages(landed)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
