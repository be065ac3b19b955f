import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerflow.session import local_session

    s = local_session("*", shuffle_partitions=8, app="ledgerflow-tests")
    yield s


@pytest.fixture(scope="session")
def spec():
    from ledgerflow.spec import transactions_spec

    return transactions_spec()


SF = "/root/testdata/sf0.001"
