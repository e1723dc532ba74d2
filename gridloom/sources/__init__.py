"""Where grids come from: workbook files, or tables."""
