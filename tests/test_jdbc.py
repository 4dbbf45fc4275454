"""JDBC wiring checks that need no database (the round trip itself is not
exercised: no database may be started here)."""

import pytest

from skyframe.sources.jdbc import read_jdbc


def test_read_jdbc_argument_checks(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none", query="select 1", table="t")
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none")
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none", table="t", partition_column="id", num_partitions=4)
