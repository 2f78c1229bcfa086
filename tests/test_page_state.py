"""State calls of a run do not grow with the copies a batch brings."""

import random

from pyspark.sql import Row

from listinglake.streaming import pages


class _State:
    """A value or a list of the state, with its calls counted."""

    def __init__(self, calls, several):
        self.calls, self.several, self.kept = calls, several, [] if several else None

    def get(self):
        self.calls.append("get")
        return iter(list(self.kept)) if self.several else self.kept

    def update(self, value):
        self.calls.append("update")
        self.kept = value

    def appendValue(self, value):
        self.calls.append("append")
        self.kept.append(value)

    def clear(self):
        self.calls.append("clear")
        self.kept = []


class _Handle:
    def __init__(self):
        self.calls = []

    def getValueState(self, name, schema):
        return _State(self.calls, False)

    def getListState(self, name, schema):
        return _State(self.calls, True)


def test_a_batch_costs_a_run_few_state_calls_whatever_it_brings():
    handle, run = _Handle(), pages._Run()
    run.init(handle)
    copies = [(page, page * 10 + copy, page != 700) for page in range(1, 1001) for copy in range(3)]
    random.Random(3).shuffle(copies)
    used = []
    for start in range(0, len(copies), 500):
        handle.calls.clear()
        batch = [Row(run="a", page=p, request_seq=r, leads=leads) for p, r, leads in copies[start : start + 500]]
        used += [(row.page, row.request_seq) for row in run.handleInputRows(("a",), iter(batch), None)]
        assert len(handle.calls) <= 5
    assert sorted(used) == sorted((page, request) for page, request, _ in copies if page <= 700)


def test_spans_of_pages_join_neighbours():
    assert pages._with_pages([(2, 3), (7, 9)], {4, 6, 12, 8}) == [(2, 4), (6, 9), (12, 12)]
    assert pages._with_pages([], set()) == []


def test_a_copy_that_lands_twice_while_it_waits_counts_once():
    run = pages._Run()
    run.init(_Handle())
    batches = [[(3, 30, True)], [(3, 30, True), (2, 20, True)], [(1, 10, True)]]
    used = []
    for batch in batches:
        rows = [Row(run="a", page=p, request_seq=r, leads=leads) for p, r, leads in batch]
        used += [(row.page, row.request_seq) for row in run.handleInputRows(("a",), iter(rows), None)]
    assert sorted(used) == [(1, 10), (2, 20), (3, 30)]
