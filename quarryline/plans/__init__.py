"""Named queries over the test tables, each with SQL for comparison where SQL can express it."""
