"""Column names shared by every step. All of them are only defaults."""

from __future__ import annotations

from dataclasses import dataclass

# Names and formats of the raw retail file.
IDENTITY_COLUMNS = (
    "Invoice ID",
    "Customer Type",
    "Customer Name",
    "Customer Gender",
    "Employee Name",
    "Product Name",
    "Manager Name",
    "Channel",
    "Customer Satisfaction",
)
DATE_FORMAT = "M/d/yyyy"


@dataclass(frozen=True)
class SalesColumns:
    """Names of the four required columns, plus the week the steps derive."""

    date: str = "Invoice Date"
    city: str = "City"
    category: str = "Product Category"
    sales: str = "Total Sales"
    week: str = "Week Start"

    @property
    def required(self) -> dict[str, str]:
        """Required columns with the type each is coerced to.

        Money is an exact decimal rather than a float, so that sums do not
        depend on the order in which partitions arrive.
        """
        return {
            self.date: "string",
            self.city: "string",
            self.category: "string",
            self.sales: "decimal(18,4)",
        }


RETAIL = SalesColumns()
