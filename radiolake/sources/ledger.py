"""Which batch of which writer has which number in the tables.

Streams and batch jobs count their own batches from 0; the tables count all of them. A writer claims
a number before it writes and marks it done after, so a batch that comes again finds its number or
that it is done already. Numbers are never used twice: claims are files that only one writer can
create. Writers take turns; a number that is claimed but not done belongs to a writer that failed.

No call lists a folder: a claim is looked up by its name, the last number is noted beside them. Files
appear whole, by a rename. One that was cut off all the same says nothing: the last number is then
counted from 0 and a claim is found by the text of its number.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import SparkSession

from radiolake.sources.storage import exists, read_text, replace_text, write_new


@dataclass(frozen=True)
class Claim:
    """`left_over` is a number of a failed writer whose rows must go first."""

    number: int
    done: bool
    left_over: int | None = None


class Ledger:
    def __init__(self, spark: SparkSession, out: str) -> None:
        self.spark, self.place = spark, f"{out}/_ledger"

    def _state(self, number: int, mark: str) -> bool:
        return exists(self.spark, f"{self.place}/{mark}/{number}")

    def last(self) -> int:
        """The highest number claimed; -1 when there is none."""
        number = int(read_text(self.spark, f"{self.place}/last") or -1)
        while self._state(number + 1, "number"):  # noted after the claim; a failure lies between
            number += 1
        return number

    def claim(self, writer: str, batch: int) -> Claim:
        own = f"{self.place}/claim/{quote(writer, safe='')}/{batch}"
        last = self.last()
        open_number = last if last >= 0 and not self._closed(last) else None
        held = read_text(self.spark, own) or self._noted(own, f"{writer} {batch}", last)
        if held is not None:
            number = int(held)
            if self._state(number, "done"):
                return Claim(number, done=True)
            if number == open_number:
                return Claim(number, done=False, left_over=number)
        number = last + 1
        while not write_new(self.spark, f"{self.place}/number/{number}", f"{writer} {batch}"):
            number += 1
        replace_text(self.spark, own, str(number))
        replace_text(self.spark, f"{self.place}/last", str(number))
        return Claim(number, done=False, left_over=open_number)

    def _noted(self, own: str, text: str, last: int) -> int | None:
        """The number of a claim whose own file was cut off: the number's file says whose it is."""
        if not exists(self.spark, own):
            return None
        numbers = (n for n in range(last, -1, -1) if read_text(self.spark, f"{self.place}/number/{n}") == text)
        return next(numbers, None)

    def _closed(self, number: int) -> bool:
        return self._state(number, "done") or self._state(number, "dropped")

    def drop(self, number: int) -> None:
        """The rows of this number are gone and it will not be used."""
        write_new(self.spark, f"{self.place}/dropped/{number}", "dropped")

    def finish(self, number: int) -> None:
        write_new(self.spark, f"{self.place}/done/{number}", "done")
