"""Every query of the catalogue gives the rows of its SQL on the smallest of the driver's tables."""

import os

import pytest
from compare import difference

from folio.plans import books, catalogue  # noqa: F401 (registers its queries)

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(spark, FOLDER, catalogue.QUERIES[name], catalogue.ORACLES[name]) is None
