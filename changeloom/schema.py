"""Names and types every operator agrees on."""

from __future__ import annotations

# Change row: one event of one table.
#   db, schema, table   where it happened
#   op                  r snapshot read, c create, u update, d delete
#   pos, sub            total order. pos is the event's place: file number and place in the file packed
#                       into one number, or a text of fixed width that sorts alike where the counters need more
#                       than 63 bits (see sources.position). sub orders the rows of one event: twice the row number, plus 1 for the second half of a row that was split in two.
#   event_ts, fetch_ts  milliseconds since the epoch
#   key, before, after  structs
ORDER = ["pos", "sub"]

# Row kinds of a kinded row.
INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"

# Option defaults.
CHUNK_SIZE = 8096
FETCH_SIZE = 1024
FACTOR_LOWER = 0.05
FACTOR_UPPER = 1000.0
DOCUMENT_CHUNK_MB = 64
