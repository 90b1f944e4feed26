"""Plan for the employee table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import tenure_years
from ..functions.text import full_name, map_values, title_case
from ..operators.features import JOB_LEVELS, add_threshold_flags, salary_band

# Columns of the clean table, in order.
CLEAN_COLUMNS = [
    "No", "Full_Name", "First_Name", "Last_Name", "Gender", "Start_Date", "Tenure_Years", "Department",
    "Country", "Center", "Monthly_Salary", "Annual_Salary", "Salary_Band", "Job_Rate", "Job_Level",
    "Sick_Leaves", "Unpaid_Leaves", "Overtime_Hours", "Has_Sick_Leave", "Has_Unpaid_Leave", "High_Overtime",
]
LEVEL_ORDER = ["Junior", "Mid", "Senior", "Lead", "Principal"]
NUMERIC = ["Monthly_Salary", "Tenure_Years", "Job_Rate", "Sick_Leaves", "Unpaid_Leaves", "Overtime_Hours"]

# Names under which the department summary is exported.
DEPT_DISPLAY = {
    "Avg_Monthly_Salary": "Avg Monthly Salary ($)",
    "Total_Annual_Cost": "Total Annual Cost ($)",
    "Avg_OT_Hours": "Avg OT Hours",
    "Sick_Leave_Count": "Sick Leave #",
    "High_OT_Count": "High OT #",
}


def clean_employees(df: DataFrame, ref_date: str = "2021-01-01") -> DataFrame:
    """Names, tenure at `ref_date`, salary band, job level and leave flags."""
    df = df.withColumns({"First_Name": title_case("First_Name"), "Last_Name": title_case("Last_Name")})
    df = df.withColumns(
        {
            "Full_Name": full_name("First_Name", "Last_Name"),
            "Tenure_Years": tenure_years("Start_Date", ref_date),
            "Salary_Band": salary_band("Monthly_Salary"),
            "Job_Level": map_values("Job_Rate", JOB_LEVELS, keep_others=False),
        }
    )
    return add_threshold_flags(df).select(*CLEAN_COLUMNS)
