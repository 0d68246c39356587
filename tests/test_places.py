"""Lines of parents: trees of any depth, missing parents, cycles, no places."""

from stallkeeper.operators.geo import geocode, top_places
from stallkeeper.plans.stages import stages_in

PLACES = "place_id string, parent_id string, up string, levels int"


def tops(spark, folder, pairs):
    rows = spark.createDataFrame([(a, b, "x", 7) for a, b in pairs], PLACES)
    return {r.place_id: (r.top, r.levels) for r in top_places(rows, stages_in(folder)).collect()}


def test_lines_of_parents(spark, folder):
    chain = [("p0", None)] + [(f"p{i}", f"p{i - 1}") for i in range(1, 38)]
    cycle = [("a", "b"), ("b", "c"), ("c", "a"), ("below", "a"), ("own", "own")]
    found = tops(spark, folder, [*chain, *cycle, ("lost", "nowhere"), ("child", "lost")])
    assert all(found[f"p{i}"] == ("p0", i) for i in range(38))
    assert all(found[n] == (None, None) for n in ("a", "b", "c", "below", "own"))
    assert found["lost"] == ("lost", 0) and found["child"] == ("lost", 1)


def test_no_places_and_places_without_a_name(spark, folder):
    assert tops(spark, f"{folder}/none", []) == {}
    assert tops(spark, f"{folder}/null", [(None, "a"), ("a", None)]) == {"a": ("a", 0)}


def test_lookup_tables_are_written_once(spark, folder):
    """What a lookup table is made of is computed for its stage and for nothing else."""
    seen, counted = [], spark.sparkContext.accumulator(0)
    write = stages_in(folder)

    def stage(rows, name):
        seen.append(name)
        return write(rows, name)

    def passed(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    places = spark.createDataFrame([("France", 1.0, 2.0, "FR"), ("Paris", 3.0, 4.0, "FR")], "name string, lat double, lon double, country string")
    places = places.mapInArrow(passed, places.schema)
    rows = spark.createDataFrame([(1, "Paris, France"), (2, "Nowhere"), (3, None)], "id int, location string")
    found = geocode(rows, places, ["id"], stage).collect()
    assert {r.id: r.loc_name for r in found} == {1: "Paris", 2: None, 3: None}
    assert seen == ["places_table", "locations_table"]
    assert counted.value == 2
