"""Hot persons: the summary and reports give the same rows when persons are walked in blocks."""

import pytest

from caretrail.plans import contact, programs
from caretrail.plans.hiv_summary import CURRENT_FORM, OUTPUT, hiv_summary
from caretrail.sources.tables import Tables
from tests.conftest import SMALL


class Skewed(Tables):
    """Tables that take a few persons for hot ones."""

    hot_persons = [4, 10, 17, 33, 50]
    hot_lab_persons = [4, 9]


def rows(df):
    return sorted(str(r) for r in df.collect())


@pytest.mark.parametrize(
    "build",
    [
        lambda t: hiv_summary(t, columns=OUTPUT + CURRENT_FORM),
        lambda t: contact.appointments(t).select(*contact.appointment_columns()),
        programs.viral_load_history,
        programs.prep_summary,
    ],
)
def test_blocked_persons_give_the_same_rows(spark, build):
    assert rows(build(Skewed(spark, SMALL))) == rows(build(Tables(spark, SMALL)))
