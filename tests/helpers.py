"""Plan inspection for tests."""

import re

UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow")


def executed_plan(df) -> str:
    """The plan as it ran, after adaptive changes; the rows are computed."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count_nodes(plan: str, name: str) -> int:
    return len(re.findall(rf"\b{name}\b", plan))


def _children(node):
    children = node.children()
    return [children.apply(i) for i in range(children.size())]


def exchange_columns(df) -> list[list[str]]:
    """Output columns of every shuffle in the plan before adaptive changes."""
    found, todo = [], [df._jdf.queryExecution().executedPlan().initialPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            output = node.output()
            found.append([output.apply(i).name() for i in range(output.size())])
        todo.extend(_children(node))
    return found
