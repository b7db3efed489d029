"""Expense vocabulary: sheet headers and category labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# Headers of an expense sheet and their column names.
SHEET_HEADERS = {
    "Дата": "day_month_raw",
    "Гос. номер": "vehicle_plate",
    "Водитель": "driver_name",
    "Статья затрат": "expense_category",
    "Контрагент (кому заплатили)": "counterparty",
    "Номер документа": "document_number",
    "Сумма, руб.": "amount_rub",
    "Примечание": "comment",
}

# Fixed value: the document number of the total row that closes a sheet.
TOTAL_MARKER = "ИТОГО:"

# Expense labels and their category; any other label is 'other'.
CATEGORY_OF_LABEL = {
    "Топливо": "fuel",
    "ГСМ": "fuel",
    "Бензин": "fuel",
    "Ремонт": "repair",
    "Запчасти": "repair",
    "Техобслуживание": "repair",
    "ТО": "repair",
    "Мойка": "wash",
    "Мойка авто": "wash",
}


def category_of(label: Column) -> Column:
    """Exact, case-sensitive label match."""
    mapping = F.create_map(*(F.lit(x) for x in chain.from_iterable(CATEGORY_OF_LABEL.items())))
    return F.coalesce(F.try_element_at(mapping, label), F.lit("other"))
