"""Exact scores of (entity, record) pairs.

Names and lines are normalised once on either side, as columns; only the string kernels run in Python, over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom import constants as C
from linkloom.functions.normalize import body_of, clean, core_of, norm_address, number_of, present
from linkloom.functions.scores import Form, Record, best_city, overlap, weighted
from linkloom.operators.blocking import partitions


def forms(c: Column | str) -> Column:
    """Each name as text, cleaned, and core."""
    full = F.transform(F.col(c) if isinstance(c, str) else c, lambda x: F.struct(x.alias("text"), clean(x).alias("full")))
    return F.transform(full, lambda x: F.struct(x["text"].alias("text"), x["full"].alias("full"), core_of(x["full"]).alias("core")))


def lines(c: Column | str) -> Column:
    """Each line that isn't blank as number and body."""
    normed = F.transform(present(c), lambda x: norm_address(x))
    return F.transform(normed, lambda x: F.struct(number_of(x).alias("number"), body_of(x).alias("body")))


def prepared_entities(df: DataFrame, names: str = "names") -> DataFrame:
    """entity_id and what its scores need, from pooled and normalised rows."""
    return df.select("entity_id", forms(names).alias("e_names"), lines("addrs").alias("e_lines"), "cities_n", "states_n", "zips_n")


def prepared_directory(known: DataFrame) -> DataFrame:
    one = lambda c: F.filter(F.array(c), lambda x: x.isNotNull() & (x != ""))
    return known.select(
        "ref_id", "entity_type", F.col("name").alias("ref_name"), forms(one("primary")).alias("d_primary"), forms("aliases").alias("d_aliases"),
        lines(F.array("addr1", "addr2")).alias("d_lines"), one("city_n").alias("d_cities"), one("state_n").alias("d_states"), one("zip5").alias("d_zips"),
    )


def prepared_locations(index: DataFrame) -> DataFrame:
    piece = F.col("piece") if "piece" in index.columns else F.lit(0).alias("piece")
    return index.select("ref_id", piece, "loc_n", forms("loc_names").alias("l_names"), lines("loc_addrs").alias("l_lines"), "loc_cities", "loc_states", "loc_zips")


def prepared_records(known: DataFrame, index: DataFrame) -> DataFrame:
    """Records with their locations: a row for each piece of those; what the record itself says is in its first row only."""
    out = prepared_directory(known).join(prepared_locations(index), "ref_id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("loc_n", "piece")})
    return out.withColumns({c: F.when(F.col("piece") == 0, F.col(c)) for c in ("d_primary", "d_aliases", "d_lines", "d_cities", "d_states", "d_zips")})


_RECORD = (("entity_type", T.StringType()), ("ref_name", T.StringType()), ("loc_n", T.LongType()))
_SCORES = (
    ("state_score", T.DoubleType()), ("zip_score", T.DoubleType()), ("name_score", T.DoubleType()), ("number_score", T.DoubleType()), ("body_score", T.DoubleType()), ("city_score", T.DoubleType()),
    ("address_source", T.StringType()), ("matched_name", T.StringType()), ("matched_ref_name", T.StringType()), ("matched_via", T.StringType()), ("matched_words", T.IntegerType()),
)
_ARROW = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.DoubleType(): pa.float64(), T.IntegerType(): pa.int32()}
_OWN = ("e_names", "e_lines", "cities_n", "states_n", "zips_n")
_HELD = ("d_primary", "d_aliases", "l_names", "d_lines", "l_lines", "d_cities", "loc_cities", "d_states", "loc_states", "d_zips", "loc_zips", "entity_type", "ref_name", "loc_n")
#: Pairs of a record that a task scores at most, about, and rows read and written at a time.
PAIRS, ROWS = 8192, 1024


class _Held:
    """A piece of a record, prepared for the pairs of the record."""

    def __init__(self, primary, aliases, places, hq, more, at, towns, states, other_states, zips, other_zips, *values):
        self.hq = len(hq or ())
        names = [(_form(x), via) for found, via in ((primary, "Name"), (aliases, "Alias"), (places, "Location")) for x in found or ()]
        self.record = Record(names, [_line(x) for x in (*(hq or ()), *(more or ()))])
        self.cities = [*(at or ()), *(towns or ())]
        self.states, self.zips = {*(states or ()), *(other_states or ())}, {*(zips or ()), *(other_zips or ())}
        self.values = values


class _Asked:
    """Pairs of a record that a task scores: each distinct name and line meets the record's pieces one after the other."""

    def __init__(self, key: tuple):
        self.key, self.rows, self.batches = key, [], []
        self.names: dict[Form, tuple[float, str, str, str, int]] = {}
        self.lines: dict[tuple[str, str], tuple[float, float | None, float | None, str]] = {}
        self.first: _Held | None = None

    def add(self, rows: list[tuple], batch: pa.RecordBatch) -> None:
        self.rows += rows
        self.batches.append(batch)
        for names, lines_, *_ in rows:
            self.names |= dict.fromkeys(names, _NO_NAME)
            self.lines |= dict.fromkeys(lines_, _NO_LINE)

    def meet(self, held: _Held) -> None:
        """An earlier piece goes before a later one of equal score."""
        self.first = self.first or held
        held.record.meet(self.names)
        for x, best in self.names.items():
            found = held.record.best_name([x])
            if found[0] > best[0]:
                self.names[x] = found
        for x, best in self.lines.items():
            number, body, i = held.record.best_address([x])
            if i is not None and (number or 0.0) + (body or 0.0) > best[0]:
                self.lines[x] = ((number or 0.0) + (body or 0.0), number, body, "HQ" if i < held.hq else "Location")

    def scores(self) -> Iterator[tuple]:
        held = self.first
        for names, lines_, cities, states, zips in self.rows:
            # max keeps the first of equals.
            name, text, other, via, count = max((self.names[x] for x in names), key=itemgetter(0), default=_NO_NAME)
            _, number, body, source = max((self.lines[x] for x in lines_), key=itemgetter(0), default=_NO_LINE)
            yield (*held.values, overlap(states, held.states), overlap(zips, held.zips), name, number, body, best_city(cities, held.cities), source, text, other, via, count)


_NO_NAME, _NO_LINE = (0.0, "", "", "", 0), (-1.0, None, None, "")


def _form(x: dict) -> Form:
    return x["text"] or "", x["full"], x["core"]


def _line(x: dict) -> tuple[str, str]:
    return x["number"], x["body"]


def _lists(column: pa.ListArray, *fields: str) -> list[list]:
    """A list for each row, empty for a null; structs as tuples of their fields. Values are read all at once, not row by row."""
    flat = column.flatten()
    values = list(zip(*(flat.field(f).to_pylist() for f in fields))) if fields else flat.to_pylist()
    sizes = column.value_lengths().to_pylist()
    out, at = [], 0
    for n in sizes:
        out.append(values[at : at + (n or 0)])
        at += n or 0
    return out


def scored(pairs: DataFrame, own: DataFrame, records: DataFrame) -> DataFrame:
    """pairs (entity_id, ref_id and more) with every component score, address_score, match_score and what won; own, records: the prepared sides, records with their locations.

    A record goes once to each task that scores pairs of it, after them, so its names and lines aren't repeated for each pair; a
    record of many pairs is dealt to several tasks. A task holds the pairs of one record, PAIRS or so, and a piece of it.
    """
    count = pairs.groupBy("ref_id").agg(F.ceil(F.count("*") / PAIRS).cast("int").alias("_parts"))
    asked = pairs.join(own, "entity_id").join(count, "ref_id")
    asked = asked.select(*pairs.columns, *_OWN, F.pmod(F.xxhash64("entity_id"), F.col("_parts")).cast("int").alias("_part"), F.lit(0).alias("_kind"), F.lit(0).alias("piece"))
    held = records.join(count, "ref_id").select("ref_id", "piece", *_HELD, F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"), F.lit(1).alias("_kind"))
    dealt = asked.unionByName(held, allowMissingColumns=True).repartition(partitions(pairs.sparkSession), "ref_id", "_part").sortWithinPartitions("ref_id", "_part", "_kind", "piece")
    kept = [f for f in pairs.schema.fields if f.name != "ref_id"]
    fields = [pairs.schema["ref_id"], *kept, *(T.StructField(n, t) for n, t in (*_RECORD, *_SCORES))]
    names, more = ["ref_id", *(f.name for f in kept)], [n for n, _ in (*_RECORD, *_SCORES)]
    kinds = [_ARROW[t] for _, t in (*_RECORD, *_SCORES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ready = [], []

        def done(part: _Asked | None, least: int) -> Iterator[pa.RecordBatch]:
            if part and part.first and part.rows:  # else not in the directory
                rows.extend(part.scores())
                ready.extend(part.batches)
            if len(rows) >= least:
                asked = pa.Table.from_batches(ready).combine_chunks()
                every = pa.table([*asked.columns, *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names=[*names, *more])
                rows.clear(), ready.clear()
                yield from every.to_batches()

        part = None
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                b = whole.slice(start, ROWS)
                keys = list(zip(*(b.column(c).to_pylist() for c in ("ref_id", "_part", "_kind"))))
                named = [[(text or "", full, core) for text, full, core in x] for x in _lists(b.column("e_names"), "text", "full", "core")]
                own = list(zip(named, _lists(b.column("e_lines"), "number", "body"), *(_lists(b.column(c)) for c in _OWN[2:])))
                place = 0
                for (*key, kind), group in groupby(keys):
                    first, place = place, place + sum(1 for _ in group)
                    if part is None or part.key != key:
                        yield from done(part, ROWS)
                        part = _Asked(key)
                    if kind == 0:
                        part.add(own[first:place], b.select(names).slice(first, place - first))
                    else:
                        for i in range(first, place):
                            part.meet(_Held(*(b.column(c)[i].as_py() for c in _HELD)))
        yield from done(part, 1)

    done = dealt.mapInArrow(run, T.StructType(fields))
    parts = {"number": F.col("number_score"), "body": F.col("body_score"), "city": F.col("city_score"), "state": F.col("state_score"), "zip": F.col("zip_score")}
    return done.withColumns({"address_score": weighted(parts, C.ADDRESS_WEIGHTS), "match_score": weighted({"name": F.col("name_score"), **parts}, C.MATCH_WEIGHTS)})
