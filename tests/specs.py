"""Specifications the tests share."""

import copy


def field(kind, **more):
    return {"type": f"{kind}Type", "nullable": False, **more}


INT, STR, DAY = field("Integer"), field("String"), field("Date")
FLAG, REAL = field("Boolean"), field("Double")
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
MAILS = [f"user{i}@mail{i % 3}.com" for i in range(100)]

# Four tables of 1,000 rows.
FOUR = {
    "datasets": {
        "df1": {"size": 1000, "schema": {"user_id": INT, "name": STR, "surname": STR, "birthdate": DAY}},
        "df2": {"size": 1000, "schema": {"user_id": INT, "purchase": STR, "date": DAY}},
        "df3": {"size": 1000, "schema": {"date": DAY, "item": STR, "is_bought": FLAG}},
        "df4": {"size": 1000, "schema": {"item": STR, "weight": REAL, "description": STR}},
    },
    "restrictions": {"min_int": 0, "max_int": 5000, "min_double": 0.0, "max_double": 100.0},
    "join_conditions": {
        "j1": {"condition": ("user_id", "user_id"), "type": "left", "intersecting_records": 20},
        "j2": {"condition": ("date", "date"), "type": "right", "intersecting_records": 20},
        "j3": {"condition": ("item", "item"), "type": "inner", "intersecting_records": 10},
    },
}

# Users, what they buy, and products.
SHOP = {
    "datasets": {
        "user_info": {
            "size": 40,
            "schema": {
                "user_id": field("Integer", restriction=(0, 100)),
                "user_name": field("String", string_format="?###???#?#?", letters=LETTERS),
                "email": field("String", values=MAILS),
                "premium": FLAG,
            },
        },
        "user_buy": {
            "size": 20,
            "schema": {
                "user_id": INT,
                "bought_date": field("Date", restriction=("1200-01-01", "2020-01-01")),
                "product_id": INT,
            },
        },
        "product": {"size": 20, "schema": {"product_id": INT, "product_name": STR, "price": REAL}},
    },
    "restrictions": {
        "min_int": 0, "max_int": 100, "min_double": 0.0, "max_double": 100.0,
        "min_date": "1979-01-01", "max_date": "2047-12-02",
        "string_format": "?###???#?#?", "letters": LETTERS, "save_to_csv": True,
    },
    "join_conditions": {
        "j1": {"condition": ("user_id", "user_id"), "type": "left", "intersecting_records": 20},
        "j2": {"condition": ("product_id", "product_id"), "type": "right", "intersecting_records": 20},
    },
}

# Names that clash, and a column all three tables have.
CLASH = {
    "datasets": {
        "data1": {"size": 20, "schema": {"user_id": INT, "user_name": STR, "email": STR, "smth": STR, "float": REAL}},
        "data2": {"size": 20, "schema": {"user_id": INT, "date": DAY, "smth": STR, "has_work": FLAG}},
        "data3": {"size": 30, "schema": {"user_id": INT, "date": DAY, "purchase": STR}},
    },
    "restrictions": {"min_int": 0, "max_int": 1000, "min_double": 0.0, "max_double": 1000.0},
    "join_conditions": {
        "j1": {"condition": ("user_id", "user_id"), "type": "inner", "intersecting_records": 15},
        "j2": {"condition": ("date", "date"), "type": "inner", "intersecting_records": 10},
    },
}


def changed(spec, **parts):
    """A copy with some values set: ``changed(SHOP, product__size=5)``."""
    spec = copy.deepcopy(spec)
    for path, value in parts.items():
        *where, last = path.split("__")
        at = spec
        for name in where:
            at = at[name]
        at[last] = value
    return spec


def table_of(spec, name, **columns):
    """A copy with columns of one table replaced."""
    spec = copy.deepcopy(spec)
    spec["datasets"][name]["schema"].update(columns)
    return spec


def joins_of(spec, types=None, matches=None, where=None):
    """A copy with other join types, numbers of matches, and filters."""
    spec = copy.deepcopy(spec)
    for i, join in enumerate(spec["join_conditions"].values()):
        if types:
            join["type"] = types[i]
        if matches:
            join["intersecting_records"] = matches[i]
        if where and where[i]:
            join["where"] = where[i]
    return spec
