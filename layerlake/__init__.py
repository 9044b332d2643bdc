"""layerlake: layered retail analytics as plain DataFrame functions.

Every operator takes DataFrames plus column names and returns a DataFrame.
Nothing here holds a global session, names a table inside an operator, or
uses a Python UDF.
"""
