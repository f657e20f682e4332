"""Training-data operators: ten corpus operators built on Spark tasks with numpy inside them."""
