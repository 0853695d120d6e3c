import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from namewright.session import local_session  # noqa: E402

META_SCHEMA = ("object_id long, object_type_id int, attribute string, verb string, ric string, "
               "element_id long, element string, element_name string")
MEMBER_SCHEMA = "load_set_id int, curve_id long"
DICT_SCHEMA = "element_id long, abbr string"
RULE_SCHEMA = ("load_set_id int, longname_rule_exp string, shortname_rule_exp string, "
               "desc_rule_exp string, curvename_status_id int")
NAME_SCHEMA = ("load_set_id int, curve_id long, curve_name string, short_curve_name string, "
               "curve_description string")


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="namewright-tests")
    yield s
    s.stop()


def meta_row(obj, attr, verb, name, short=None, eid=None, ric=None, typ=1):
    return (obj, typ, attr, verb, ric, eid, short if short is not None else name, name)


@pytest.fixture
def tables(spark):
    """Builder for literal catalogue tables."""
    def make(meta, members, rules, dictionary=(), names=()):
        return {
            "meta": spark.createDataFrame(list(meta), META_SCHEMA),
            "members": spark.createDataFrame(list(members), MEMBER_SCHEMA),
            "dict": spark.createDataFrame(list(dictionary), DICT_SCHEMA),
            "rules": spark.createDataFrame(list(rules), RULE_SCHEMA),
            "names": spark.createDataFrame(list(names), NAME_SCHEMA),
        }
    return make
