"""Small tables with hand-checked results."""

import datetime as dt

# The rows behind the expected results in the tests.
USERS = [(1, "Alice", 30), (2, "Bob", 25), (3, "Charlie", 35), (4, "Diana", 28)]
AUTHORS = [(1, "Ursula K. Le Guin"), (2, "Ted Chiang"), (3, "N. K. Jemisin"), (4, "Unpublished Author")]
BOOKS = [
    (1, "A Wizard of Earthsea", 1968, 1),
    (2, "The Dispossessed", 1974, 1),
    (3, "Stories of Your Life", 2002, 2),
    (4, "Exhalation", 2019, 2),
    (5, "The Fifth Season", 2015, 3),
]
CUSTOMERS = [(1, "Alice"), (2, "Bob"), (3, "Carol")]
ORDERS = [
    (1, 1, 100, "shipped"),
    (2, 1, 50, "shipped"),
    (3, 1, 80, "cancelled"),
    (4, 2, 200, "shipped"),
    (5, 2, 30, "pending"),
    (6, 3, 75, "pending"),
]
SALES = [
    (1, "Widget", "North", 100, "2025-01-05"),
    (2, "Widget", "North", 150, "2025-01-18"),
    (3, "Widget", "South", 200, "2025-02-02"),
    (4, "Gadget", "North", 80, "2025-01-11"),
    (5, "Gadget", "South", 120, "2025-02-20"),
    (6, "Gizmo", "North", 50, "2025-03-07"),
    (7, "Gizmo", "South", 90, "2025-03-15"),
]
DATED_SALES = [
    (1, "Widget", "North", 100, "2025-01-05"),
    (2, "Widget", "North", 150, "2025-01-18"),
    (3, "Widget", "North", 120, "2025-02-02"),
    (4, "Widget", "South", 200, "2025-01-10"),
    (5, "Widget", "South", 180, "2025-02-08"),
    (6, "Gadget", "North", 80, "2025-01-11"),
    (7, "Gadget", "North", 110, "2025-02-19"),
    (8, "Gadget", "South", 120, "2025-02-20"),
    (9, "Gadget", "South", 95, "2025-03-02"),
]
EMPLOYEES = [(1, "Ada", None), (2, "Bella", 1), (3, "Cleo", 1), (4, "Dev", 2), (5, "Eli", 2), (6, "Fatou", 4)]
PAYLOADS = [
    (1, "signup", '{"user": "alice", "plan": "pro", "source": {"campaign": "spring25", "medium": "email"}}'),
    (2, "signup", '{"user": "bob", "plan": "free", "source": {"campaign": "spring25", "medium": "ads"}}'),
    (3, "purchase", '{"user": "alice", "items": [{"sku": "A1", "qty": 2}, {"sku": "B7", "qty": 1}], "total": 59}'),
    (4, "purchase", '{"user": "carol", "items": [{"sku": "A1", "qty": 5}], "total": 125}'),
    (5, "signup", '{"user": "dan", "plan": "pro", "source": {"campaign": "referral", "medium": "link"}}'),
]
TAGS = [
    (1, ["sql", "postgres", "beginner"]),
    (2, ["sql", "advanced"]),
    (3, ["orm", "prisma", "sqlite"]),
    (4, ["postgres", "advanced", "devops"]),
]
ARTICLE_TAGS = {"a": ["redis", "database", "nosql", "redis"], "b": ["database", "sql", "postgres"]}
SCORES = [
    ("alice", 1500.0),
    ("bob", 800.0),
    ("carol", 2100.0),
    ("dan", 1200.0),
    ("eve", 1900.0),
    ("frank", 1600.0),
    ("grace", 950.0),
]


def at(seconds: float) -> dt.datetime:
    return dt.datetime(2025, 1, 1) + dt.timedelta(seconds=seconds)


class Samples:
    def __init__(self, spark):
        make = spark.createDataFrame
        self.users = make(USERS, "id int, name string, age int")
        self.authors = make(AUTHORS, "id int, name string")
        self.books = make(BOOKS, "id int, title string, year int, author_id int")
        self.customers = make(CUSTOMERS, "id int, name string")
        self.orders = make(ORDERS, "id int, customer_id int, total int, status string")
        self.sales = make(SALES, "id int, product string, region string, amount int, sold_on string")
        self.dated = make(DATED_SALES, "id int, product string, region string, amount int, sold_on string")
        self.employees = make(EMPLOYEES, "id int, name string, manager_id int")
        self.payloads = make(PAYLOADS, "id int, type string, payload string")
        self.tags = make(TAGS, "id int, tags array<string>")
        self.scores = make(SCORES, "player string, score double")


def rows(df, *columns):
    """Rows as tuples in their own order."""
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def bag(df, *columns):
    """Rows as tuples in a fixed order, whatever order they came in."""
    return sorted(rows(df, *columns), key=repr)
