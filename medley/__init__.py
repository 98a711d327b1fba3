"""medley: everyday data-engineering operators as functions from DataFrame to DataFrame."""
