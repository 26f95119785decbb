"""Baskets as stored pages that every group of items or of customers reads again.

Work that needs all baskets for each of many groups would shuffle a copy of them to every group. Here they are stored
once, as pages: the lists of many rows as the bytes of a few arrays. A group is one task that reads its own rows, if it
has any, and all pages; so the pages take their disk once, however many groups there are.
"""

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import settle

#: Kinds of pages: items of the catalogue and baskets.
ITEMS, BASKETS = 1, 2
#: Meetings that a task looks at together, unless one item has more in a basket, and that wait to be counted.
CHUNK, PENDING = 2_000_000, 8_000_000


def paged(items: DataFrame, baskets: DataFrame, by: Sequence[str], codes_per_row: int) -> DataFrame:
    """Stored pages: by, kind, sizes, numbers, values, codes, work.

    items: by, stock_code, index, value (long). baskets: by, entries (number, reach), sorted as they are met; an entry
    meets those of its basket whose number is no greater than its reach. Of baskets, `values` counts these; `numbers`
    are the entries' lowest 32 bits.
    """
    by = list(by)
    entry = F.sort_array(F.collect_list(F.struct("index", "stock_code", F.col("value").cast("long").alias("value"))))
    listed = items.groupBy(*by, F.floor(F.col("index") / codes_per_row).alias("page")).agg(entry.alias("items"))
    code = f"array<{dict(items.dtypes)['stock_code']}>"
    numbers, reach, codes = F.col("items.index"), F.col("items.value"), F.col("items.stock_code")
    listed = listed.select(*by, F.lit(ITEMS).alias("kind"), numbers.alias("numbers"), reach.alias("reach"), codes.cast(code).alias("codes"))
    met = baskets.select(*by, F.lit(BASKETS).alias("kind"), F.col("entries.number").alias("numbers"), F.col("entries.reach").alias("reach"), F.array().cast(code).alias("codes"))
    kinds = dict(items.dtypes)
    schema = ", ".join([*[f"{name} {kinds[name]}" for name in by], f"kind int, sizes binary, numbers binary, values binary, codes {code}, work long"])
    return settle(listed.unionByName(met).mapInArrow(_packer(by), schema))


def _packer(by):
    def pack(batches):
        for batch in batches:
            rows_of = {}
            for i, key in enumerate(zip(*[batch[name].to_pylist() for name in [*by, "kind"]])):
                rows_of.setdefault(key, []).append(i)
            for key, places in rows_of.items():
                rows = batch.take(pa.array(places))
                sizes = rows["numbers"].value_lengths().to_numpy().astype(np.int32)
                numbers, values = rows["numbers"].flatten().to_numpy(), rows["reach"].flatten().to_numpy()
                if key[-1] == BASKETS:
                    values = _within(sizes, numbers, values)
                    numbers, values = numbers.astype(np.uint32), values.astype(np.int32)
                codes = rows["codes"].flatten()
                kept = pa.ListArray.from_arrays(pa.array([0, len(codes)], pa.int32()), codes)
                columns = [rows[name][:1] for name in [*by, "kind"]]
                columns += [pa.array([part.tobytes()], pa.binary()) for part in (sizes, numbers, values)]
                work = int(values.sum()) if key[-1] == BASKETS else 0
                yield pa.RecordBatch.from_arrays([*columns, kept, pa.array([work])], names=[*by, "kind", "sizes", "numbers", "values", "codes", "work"])

    return pack


def _within(sizes, numbers, reach):
    """For each entry, how many of its basket, which is sorted, are no greater than its reach."""
    basket = np.repeat(np.arange(len(sizes)), sizes)
    known = np.unique(numbers)
    width = len(known) + 1
    own = basket * width + np.searchsorted(known, numbers) + 1
    last = basket * width + np.searchsorted(known, reach, "right")
    return np.searchsorted(own, last, "right") - np.repeat(np.cumsum(sizes) - sizes, sizes)


def rows_of(batches, by):
    """The rows of pages: (key, kind, sizes, numbers, values, codes, [(value, type)] of the columns of the key)."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            own = [(row[name][0].as_py(), row[name].type) for name in by]
            kind = row["kind"][0].as_py()
            kinds = (np.int32, np.uint32, np.int32) if kind == BASKETS else (np.int32, np.int64, np.int64)
            parts = [np.frombuffer(row[name][0].as_py(), part) for name, part in zip(("sizes", "numbers", "values"), kinds)]
            yield tuple(value for value, _ in own), kind, *parts, row["codes"].flatten(), own


def past_groups(groups: int, pages: DataFrame, function: Callable, schema: str, own: Callable | None = None) -> DataFrame:
    """function(group) over all pages, and the group's own rows if there are any, in one task for each group.

    The parts come in any order. own(group): rows with the columns of the pages.
    """
    spark = pages.sparkSession
    # Spark zips the children of a union that are one partition each into one task, unless one is not
    parts = [spark.createDataFrame(spark.sparkContext.emptyRDD(), schema)]
    for group in range(groups):
        stream = own(group).unionByName(pages, allowMissingColumns=True) if own else pages
        parts.append(stream.coalesce(1).mapInArrow(function(group), schema))
    while len(parts) > 1:  # as a balanced tree, since a chain of many unions is too deep
        parts = [reduce(DataFrame.union, parts[i : i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]


def groups_for(work: int, most: int, least: int, slots: int) -> int:
    """As many groups as the work needs, or as run at once if each then has at least `least`."""
    return max(1, min(slots, -(-work // least)), -(-work // most))


class _Pairs:
    """The items of a group and what they met in the baskets seen, counted."""

    def __init__(self, group, groups):
        self.group, self.groups = group, groups
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pending, self.waiting, self.listed = [], 0, []

    def meet(self, sizes, numbers, within):
        owner = ((numbers.astype(np.uint64) * np.uint64(2654435761) & np.uint64(0xFFFFFFFF)) * np.uint64(self.groups)) >> np.uint64(32)
        mine = np.flatnonzero((owner == self.group) & (within > 0))
        start = np.repeat(np.cumsum(sizes, dtype=np.int64) - sizes, sizes)[mine]
        width = within[mine].astype(np.int64)
        done = np.cumsum(width)
        first = 0
        while first < len(mine):
            before = done[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(done, before + CHUNK, "right")))
            some, target = width[first:last], numbers[mine[first:last]].astype(np.int64)
            at = np.arange(some.sum()) + np.repeat(start[first:last] - np.cumsum(some) + some, some)
            other, target = numbers[at].astype(np.int64), np.repeat(target, some)
            self._add(((target << 32) | other)[target != other])
            first = last

    def _add(self, keys):
        self.pending.append(keys)
        self.waiting += len(keys)
        if self.waiting > PENDING:
            self._count()

    def _count(self):
        if not self.waiting:
            return
        keys, counts = np.unique(np.concatenate(self.pending), return_counts=True)
        self.pending, self.waiting = [], 0
        if len(self.keys):
            keys, counts = np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts])
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            keys, counts = keys[starts], np.add.reduceat(counts, starts)
        self.keys, self.counts = keys, counts

    def list_items(self, numbers, values, codes):
        self.listed.append((numbers, values, codes))

    def catalogue(self):
        """(number, value, code) of the items, in the order of their numbers."""
        number, value = (np.concatenate([part[k] for part in self.listed]) for k in (0, 1))
        order = np.argsort(number)
        return number[order], value[order], pa.chunked_array([part[2] for part in self.listed]).combine_chunks().take(pa.array(order))

    def result(self):
        """(item, other, together) in the order of the items, and of the others."""
        self._count()
        return self.keys >> 32, self.keys & 0xFFFFFFFF, self.counts


def count_pairs(pages: DataFrame, by: Sequence[str], finish: Callable, schema: str, pairs_per_group: int) -> DataFrame:
    """What finish(item, other, together, catalogue) makes of the pairs that the entries of baskets meet, by group.

    It yields lists of columns; those of `by` are put before them.
    """
    by = list(by)
    work = pages.agg(F.sum("work")).first()[0] or 0
    groups = groups_for(work, pairs_per_group, min(pairs_per_group, CHUNK), pages.sparkSession.sparkContext.defaultParallelism)
    names = [field.split()[0] for field in schema.split(", ")]

    def counter(group):
        def count(batches):
            found = {}
            for key, kind, sizes, numbers, values, codes, own in rows_of(batches, by):
                if key not in found:
                    found[key] = _Pairs(group, groups), own
                if kind == BASKETS:
                    found[key][0].meet(sizes, numbers, values)
                else:
                    found[key][0].list_items(numbers, values, codes)
            while found:
                pairs, own = found.popitem()[1]
                counted = pairs.result()
                if len(counted[0]):
                    for columns in finish(*counted, pairs.catalogue()):
                        columns = [part if isinstance(part, pa.Array) else pa.array(part) for part in columns]
                        own_columns = [pa.array([value] * len(columns[0]), kind) for value, kind in own]
                        yield pa.RecordBatch.from_arrays([*own_columns, *columns], names=names)

        return count

    return past_groups(groups, pages, counter, schema)
