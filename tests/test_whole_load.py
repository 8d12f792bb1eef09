"""table_create loads every year of the summary."""

from tests.conftest import SF_SMALL
from weekmart import registry


def test_table_create_loads_all_years(spark, monkeypatch):
    made, plain = [], registry._table

    def table(*args):
        made.append(plain(*args))
        return made[-1]

    monkeypatch.setattr(registry, "_table", table)
    registry.QUERIES["table_create"](spark, SF_SMALL).collect()
    want = registry._coarse(spark, SF_SMALL).groupBy("year_num").count().collect()
    assert len(want) > 1
    assert sorted(made[0].read().groupBy("year_num").count().collect()) == sorted(want)
