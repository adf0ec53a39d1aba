"""postlens: text-post analytics and supervised scoring on Spark.

Every operator is a DataFrame -> DataFrame function (or an Estimator /
Model pair) that runs distributed.  Two canonical long shapes are used
throughout:

* long features ``(id, term, value)``
* long scores   ``(id, model, prob)`` (plus ``label`` where known)

Vectors only appear at the MLlib boundary.
"""

from postlens.session import get_session

__all__ = ["get_session"]
