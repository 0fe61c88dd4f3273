"""civiclens — open-data analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns DataFrames built from Catalyst
expressions; nothing is collected to the driver except bounded metadata.
"""

__version__ = "0.1.0"
