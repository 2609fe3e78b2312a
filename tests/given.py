"""Values that several test modules share (a module of its own: ``conftest`` is ambiguous between folders)."""

import datetime as dt

SF_SMALL = "/root/testdata/sf0.001"
ARRIVAL = dt.datetime(2024, 1, 5, 12, 0, 0, 123456)
