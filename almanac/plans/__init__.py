"""Plan builders: the test-bed frames over the driver tables, the serving
layer, the dataset recipes, and the query catalog used by the driver."""
