"""Labels derived from one row: categories, groups, types and size classes."""

from __future__ import annotations

from functools import reduce
from itertools import chain
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category spelling -> cleaned category.
CLEAN_CATEGORIES = {
    "groceries": "food",
    "grocery store": "food",
    "food": "food",
    "dining": "food",
    "restaurant": "food",
    "coffee": "food",
    "transport": "transport",
    "fuel": "transport",
    "gas": "transport",
    "uber": "transport",
    "electronics": "shopping",
    "shopping": "shopping",
    "netflix": "entertainment",
    "spotify": "entertainment",
    "salary": "income",
    "salary deposit": "income",
    "utilities": "utilities",
    "electricity": "utilities",
    "water": "utilities",
}

# The earlier, shorter table, matched case-sensitively.
STRICT_CATEGORIES = {
    "groceries": "food",
    "dining": "food",
    "fuel": "transport",
    "gas": "transport",
    "uber": "transport",
    "netflix": "entertainment",
    "spotify": "entertainment",
    "electricity": "utilities",
    "water": "utilities",
}

# Words that decide the category of free text, first group first.
TEXT_KEYWORDS = {
    "food": ["restaurant", "food", "groceries", "supermarket"],
    "transport": ["uber", "taxi", "bus", "train", "fuel", "gas"],
    "entertainment": ["movie", "netflix", "concert", "game", "entertain"],
    "shopping": ["amazon", "shop", "store", "mall", "purchase"],
    "utilities": ["electric", "water", "internet", "phone", "utility"],
    "health": ["doctor", "hospital", "pharmacy", "medical"],
}

# Category names of each group; names with one of the marks are income.
CATEGORY_GROUPS = {
    "Dining": ["Food", "Coffee", "Restaurant"],
    "Retail": ["Shopping", "Electronics"],
    "Transportation": ["Transport", "Fuel"],
}
INCOME_MARKS = ["Salary", "Deposit"]

# Mark in the account name -> account type.
ACCOUNT_TYPES = {"Checking": "Checking", "Savings": "Savings", "Credit": "Credit Card"}

# Category names of each merchant type, and marks for the last one.
MERCHANT_TYPES = {
    "Subscription": ["Netflix", "Streaming"],
    "Groceries": ["Grocery Store", "Supermarket"],
    "Technology": ["Electronics"],
}
TECHNOLOGY_MARK = "Tech"

# Upper limits of the expense size classes.
SIZE_LIMITS = {"VERY_LARGE": -1000, "LARGE": -500, "MEDIUM": -100, "SMALL": 0}

# Names for negative, positive and zero amounts per naming style.
TYPE_NAMES = {
    "two_way": ("Expense", "Income", "Income"),
    "three_way": ("Expense", "Income", "Neutral"),
    "ledger": ("debit", "credit", "zero"),
}


def lookup(value: Column, mapping: Mapping[str, str]) -> Column:
    """Dictionary lookup; NULL where the key is absent."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return pairs[value]


def remap_category(category: Column, mapping: Mapping[str, str] = CLEAN_CATEGORIES,
                   default: str | None = "other", lower: bool = True,
                   null_label: str = "uncategorized") -> Column:
    """Clean a category. A NULL takes ``null_label`` first, which the table then
    maps like any other word (so it ends as ``default`` unless it is listed)."""
    filled = F.coalesce(category, F.lit(null_label))
    found = lookup(F.lower(filled) if lower else filled, mapping)
    return F.coalesce(found, F.lit(default)) if default is not None else found


def size_class(amount: Column, scale: int = 1) -> Column:
    """Size class of an expense; anything not negative is INCOME."""
    branches = F
    for name, limit in SIZE_LIMITS.items():
        branches = branches.when(amount < limit * scale, name)
    return branches.otherwise("INCOME")


def transaction_type(amount: Column, style: str = "two_way") -> Column:
    negative, positive, zero = TYPE_NAMES[style]
    return F.when(amount < 0, negative).when(amount > 0, positive).otherwise(zero)


def _listed(name: Column, groups: Mapping[str, list[str]]) -> Column:
    """The first group that lists the name, as a chain still open for more cases."""
    branches = F
    for group, names in groups.items():
        branches = branches.when(name.isin(*names), group)
    return branches


def _has_income_mark(category: Column) -> Column:
    return reduce(lambda a, b: a | b, [category.contains(mark) for mark in INCOME_MARKS])


def category_group(category: Column) -> Column:
    return (_listed(category, CATEGORY_GROUPS)
            .when(_has_income_mark(category), "Income").otherwise("Other"))


def account_type(account: Column) -> Column:
    branches = F
    for mark, kind in ACCOUNT_TYPES.items():
        branches = branches.when(account.contains(mark), kind)
    return branches.otherwise("Other")


def is_merchant(category: Column) -> Column:
    """Everything but salaries and deposits was spent at some merchant."""
    return ~_has_income_mark(category)


def merchant_type(category: Column) -> Column:
    return (_listed(category, MERCHANT_TYPES)
            .when(category.contains(TECHNOLOGY_MARK), "Technology").otherwise("General"))


def day_type(day_of_week: Column) -> Column:
    return F.when(day_of_week.isin(0, 6), "Weekend").otherwise("Weekday")


def mood(sentiment: Column, limit: float = 0.3) -> Column:
    return F.when(sentiment > limit, "up").when(sentiment < -limit, "down").otherwise("flat")


def category_of_text(lowered: Column, amount: Column,
                     keywords: Mapping[str, list[str]] = TEXT_KEYWORDS) -> Column:
    """First keyword group with a word occurring anywhere in the lower-case text;
    without any, a positive amount is income."""
    branches = F
    for label, words in keywords.items():
        branches = branches.when(
            reduce(lambda a, b: a | b, [lowered.contains(w) for w in words]), label)
    return branches.when(amount > 0, "income").otherwise("other")
