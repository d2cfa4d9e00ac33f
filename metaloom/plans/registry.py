"""Where the queries register themselves."""

from metaloom.plans.standins import Tables

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    """Registers `plan(tables)` under a name, with the SQL that gives the same rows."""
    def register(plan):
        def run(spark, folder):
            return plan(Tables(spark, folder))

        assert name not in QUERIES, name
        run.__name__, run.__doc__ = name, plan.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return plan
    return register


def sql_strip(text):
    return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"


def sql_fold(text):
    """Caseless text, for data whose only special letter is the sharp s."""
    return f"replace(lower({sql_strip(text)}), 'ß', 'ss')"


def sql_slug(text):
    spaced = f"regexp_replace(lower(strip_accents({text})), '\\([^)]*\\)', ' ', 'g')"
    return f"trim(regexp_replace({spaced}, '[^a-z0-9]+', '_', 'g'), '_')"
