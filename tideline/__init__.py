"""tideline: sensor/event stream operators as plain PySpark DataFrame functions.

Every operator takes and returns a DataFrame; event time is an explicit
``ts`` column in epoch seconds and arrival order an explicit ``seq`` column.
"""

__version__ = "0.1.0"
