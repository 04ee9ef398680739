"""The throttle with a pending timer: literal cases, and slices against one long walk."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from faultline.operators.scans import Starved


def walk(machine, times, state=(None, False)):
    kept = []
    for t in times:
        state, value = machine.step(state, t, True)
        kept.append(value)
    return kept, state


def test_steady_traffic_is_kept_once():
    assert walk(Starved(10), [0, 4, 9, 13, 19, 25, 31])[0] == [True] + [False] * 6
    # The stretch from 20 to 30 is empty: the next row is kept. A row just at the end of a stretch is, too.
    assert walk(Starved(10), [0, 4, 13, 30, 31])[0] == [True, False, False, True, False]
    assert walk(Starved(10), [0, 10, 20])[0] == [True, True, True]
    assert walk(Starved(10), [0, 0, 10, 20])[0] == [True, False, False, False]
    assert walk(Starved(10), [0, 1, 25])[0] == [True, False, True]
    assert walk(Starved(10), [0, 1, 19])[0] == [True, False, False]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 120), min_size=1, max_size=40), st.lists(st.integers(0, 120), max_size=4), st.integers(1, 14))
def test_summaries_fold_to_the_state_of_one_walk(times, cuts, gap):
    machine, times = Starved(gap), sorted(times)
    slices = [[t for t in times if a <= t < b] for a, b in zip([0, *sorted(cuts)], [*sorted(cuts), 200])]
    state, done = None, []
    for part in (x for x in slices if x):
        done += part
        summary = json.loads(json.dumps(machine.summary(part, [True] * len(part))))
        state = tuple(machine.apply(summary, state))
        assert state == walk(machine, done)[1]


def test_a_summary_does_not_grow_with_the_rows():
    assert len(Starved(1000).summary(list(range(0, 1_000_000, 10)), None)["runs"]) == 1
