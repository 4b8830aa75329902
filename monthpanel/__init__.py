"""Monthly indicator panels and forecast contests as Spark DataFrame transforms.

Every operator takes the series identity as ``keys``: one series (``keys=[]``)
and millions of series run through the same plan.
"""
