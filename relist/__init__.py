"""relist: resale-market analytics as Spark DataFrame operators.

Every operator is a function from DataFrame(s) to DataFrame, or a Column
builder; the work runs on Spark (Catalyst plans, Tungsten executes).
"""

__version__ = "0.1.0"
